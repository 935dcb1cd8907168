"""SimHash fingerprints and their search by permuted block tables.

The terms of a text are its words (lower-cased A-Z, runs of bytes above 0x20) and its pairs of neighbouring words. Each distinct term has a weight,
its kind's weight times 1 + ln(count), and votes with it on BITS signed bits, by a hash of BITS bits; a bit of the fingerprint is set where the
votes are positive. Pairs weigh more than words, since words of one language are shared by all its texts. The fingerprint is written as BITS / 4 hex
digits; likeness is the share of equal bits.

Equal texts have equal fingerprints. A null, empty or blank text has no terms and the fingerprint 00..0.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinframe.llm.common import lower_ascii, map_slices, mix, run_hashes, runs, text_bytes, text_slices, written

BITS = 128
WORD_WEIGHT, PAIR_WEIGHT = 1.0, 3.0
RADIUS = 6
_IS_WORD = np.arange(256) > 0x20
_SIGNS = np.where(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) > 0, 1.0, -1.0)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and weight of the distinct terms of rows of bytes."""
    data = lower_ascii(data)
    starts, ends = runs(_IS_WORD[data], offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    words = run_hashes(data, starts, ends)
    pair = np.flatnonzero(row[1:] == row[:-1])
    with np.errstate(over="ignore"):
        pairs = mix(words[pair] * np.uint64(0x9E3779B97F4A7C15) + words[pair + 1])
    rows, hashes = np.concatenate([row, row[pair]]), np.concatenate([words, pairs])
    weight = np.concatenate([np.full(len(words), WORD_WEIGHT), np.full(len(pairs), PAIR_WEIGHT)])
    by = np.lexsort((hashes, rows))
    rows, hashes, weight = rows[by], hashes[by], weight[by]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return rows[at], hashes[at], weight[at] * (1 + np.log(np.diff(np.append(at, len(rows)))))


def fingerprints(texts: list[str | None], bits: int = BITS) -> np.ndarray:
    """A row of bits / 8 bytes for each text."""
    raw = [(t or "").encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)]).astype(np.int64)
    rows, hashes, weight = terms(np.frombuffer(b"".join(raw), np.uint8), offsets)
    n = len(texts)
    out = np.zeros((n, bits // 8), np.uint8)
    for word in range(bits // 64):
        bytes_ = mix(hashes, 3000 + word).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            # the weight of each byte value in each text, then each value's votes on its eight bits
            for at in range(0, n, 4096):
                lo, hi = np.searchsorted(rows, (at, at + 4096))
                m = min(4096, n - at)
                held = np.bincount((rows[lo:hi] - at) << 8 | bytes_[lo:hi, k], weight[lo:hi], m << 8).reshape(m, 256)
                out[at : at + m, word * 8 + k] = np.packbits(held @ _SIGNS > 0, axis=1)[:, 0]
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The share of equal bits of fingerprints, row by row."""
    return 1 - np.bitwise_count(x ^ y).sum(axis=1) / (8 * x.shape[1])


def fingerprint(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id and fingerprint of every row of docs."""

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        got = fingerprints(rows.column(1).to_pylist(), bits)
        return pa.record_batch([rows.column(0), pa.array([x.tobytes().hex() for x in got], pa.string())], ["doc_id", "fingerprint"])

    return map_slices(docs, ["doc_id", "text"], step, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of the code points (rounded down) replaced by as many first ones of the following text, or all it has."""
    n = len(text)
    return text[: n - n // 3] + following[: n // 3]


def _compare(ids: list[int], texts: list[str], nexts: list[str], next_prints: np.ndarray, own: np.ndarray, bits: int) -> pa.RecordBatch:
    import hashlib

    changed = [edited(t, x) for t, x in zip(texts, nexts, strict=True)]
    other = fingerprints(changed, bits)
    return pa.record_batch(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
            pa.array([x.tobytes().hex() for x in own], pa.string()),
            pa.array([x.tobytes().hex() for x in other], pa.string()),
            pa.array(likeness(own, other)),
            pa.array(likeness(own, next_prints)),
        ],
        [f.split()[0] for f in _REPORT.split(", ")],
    )


_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_BORDER = ", text string, part int, last boolean"


def _stream(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Compares each row with the next one of the stream. Its first and last rows come out again as they are: with their text, the task's number, and which they are."""
    from pyspark import TaskContext

    names = [f.split()[0] for f in (_REPORT + _BORDER).split(", ")]
    first: tuple[int, str] | None = None
    held: tuple[int, str, np.ndarray] | None = None
    for batch in batches:
        for rows in text_slices(batch):
            ids, texts = rows.column(0).to_pylist(), [t or "" for t in rows.column(1).to_pylist()]
            prints = fingerprints(texts, bits)
            first = first or ((ids[0], texts[0]) if ids else None)
            if held:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], np.concatenate([held[2][None], prints])
            if ids:
                held = ids[-1], texts[-1], prints[-1]
                done = _compare(ids[:-1], texts[:-1], texts[1:], prints[1:], prints[:-1], bits)
                n = done.num_rows
                yield pa.record_batch([*done.columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())], names)
    if held:
        part = TaskContext.get().partitionId()
        none = [pa.nulls(2, k) for k in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())]
        yield pa.record_batch([pa.array([first[0], held[0]], pa.int64()), *none, pa.array([first[1], held[1]]), pa.array([part, part], pa.int32()), pa.array([False, True])], names)


def edit_report(docs: DataFrame, bits: int = BITS, partitions: int | None = None) -> DataFrame:
    """Per document, with the next one by descending doc_id (after the last: the first): n_chars, edited_sha256, both fingerprints, near_edited, near_next.

    Documents are dealt by ranges of doc_id and each range streams past in order. The last row of a range meets the first one of the next range that has any in a join
    by the ranges' numbers: two rows for each range. A document alone follows itself. Rows without a doc_id come last; equal ids stand in the order of their
    texts' hashes.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(n, *order).sortWithinPartitions(*order)
    done = written(dealt.mapInArrow(lambda batches: _stream(batches, bits), _REPORT + _BORDER), "simhash")
    border = done.where("text IS NOT NULL").select("doc_id", "text", "part", "last")
    opening = border.where("NOT last").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    # the ranges' numbers alone, one for each range, are put in order
    ranges = border.where("NOT last").select("part")
    ranges = ranges.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(0)))).alias("next_part"))
    closing = border.where("last").join(ranges, "part").join(opening, "next_part").select("doc_id", "text", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prints = fingerprints([text, following], bits)
                yield _compare([doc], [text], [following], prints[1:], prints[:1], bits)

    columns = [f.split()[0] for f in _REPORT.split(", ")]
    return done.where("text IS NULL").select(*columns).unionByName(written(closing.mapInArrow(close, _REPORT), "simhash-ends"))


def neighbours(prints: DataFrame, asked: Column, radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """fingerprint and n_near of the rows of prints (doc_id, fingerprint) that `asked` takes: how many other documents are within `radius` bits of it.

    The search runs over distinct fingerprints; copies come in as counts.
    """
    sizes = prints.groupBy("fingerprint").agg(F.count("*").alias("size"))
    found = within_radius(prints.where(asked), prints, radius, bits)
    met = found.join(sizes, found["found"] == sizes["fingerprint"])
    return met.groupBy(F.col("query").alias("fingerprint")).agg((F.sum("size") - 1).alias("n_near"))


def within_radius(queries: DataFrame, table: DataFrame, radius: int = RADIUS, bits: int = BITS) -> DataFrame:
    """query (a distinct fingerprint of queries), found (a distinct fingerprint of table) and distance, for all pairs within `radius` bits.

    The bits are cut into radius + 2 blocks. A pair within the radius differs in at most `radius` blocks, so two blocks at least are equal: there is one
    table for each choice of two blocks, keyed by them, and a pair is tested in the first table in which it meets. Both inputs: a column `fingerprint`.
    Nulls find nothing. Equal fingerprints are one entry, so copies are not expanded into pairs.
    """
    blocks = radius + 2
    borders = [round(i * bits / blocks) for i in range(blocks + 1)]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        own = df.select(F.col("fingerprint").alias(name)).where(f"{name} IS NOT NULL").distinct()

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                flags = np.unpackbits(np.frombuffer(bytes.fromhex("".join(rows.column(0).to_pylist())), np.uint8).reshape(rows.num_rows, -1), axis=1)
                cut = [np.packbits(flags[:, a:b], axis=1) for a, b in zip(borders[:-1], borders[1:], strict=True)]
                for x, y in combinations(range(blocks), 2):
                    keys = [bytes([x, y]) + bytes(r) for r in np.concatenate([cut[x], cut[y]], axis=1)]
                    yield pa.record_batch([pa.array(keys, pa.binary()), rows.column(0)], ["key", name])

        return own.mapInArrow(step, f"key binary, {name} string")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            raw = [np.unpackbits(np.frombuffer(bytes.fromhex("".join(rows.column(k).to_pylist())), np.uint8).reshape(rows.num_rows, -1), axis=1) for k in (1, 2)]
            unlike = raw[0] != raw[1]
            distance = unlike.sum(axis=1)
            clear = np.array([~unlike[:, a:b].any(axis=1) for a, b in zip(borders[:-1], borders[1:], strict=True)])
            order = np.argsort(~clear, axis=0, kind="stable")[:2]  # the first two equal blocks
            keys = rows.column(0).to_pylist()
            keep = [r for r in range(rows.num_rows) if distance[r] <= radius and (keys[r][0], keys[r][1]) == (order[0, r], order[1, r])]
            yield pa.record_batch([rows.column(1).take(pa.array(keep, pa.int64())), rows.column(2).take(pa.array(keep, pa.int64())), pa.array(distance[keep].astype(np.int32))], ["query", "found", "distance"])

    # sorted on both sides at every size: which side happens to be small must not decide the plan
    met = keyed(queries, "query").hint("merge").join(keyed(table, "found"), "key")
    return met.select("key", "query", "found").mapInArrow(test, "query string, found string, distance int")
