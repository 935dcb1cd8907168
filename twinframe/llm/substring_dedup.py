"""Removal of repeated substrings: column-wise construction of a multi-document Burrows-Wheeler transform with common prefixes.

A byte goes when a string of `length` bytes that covers it also starts in a document with a smaller doc_id.

1. slices: documents are packed into slices of about 1 MB, one compressed row each, in a table of the shared folder.
2. anchors: each string of `length` bytes is named by its minimiser, the leftmost of its 20-byte grams with the least hash; equal strings have equal
   minimisers. Each slice sends the hashes of its distinct minimisers, six bytes each, to buckets; a bucket answers with two bits for each: whether it
   occurs in more than one document, and whether more than HOT_SLICES slices hold it.
3. segments: the maximal runs of strings with one repeated minimiser, as distinct texts of 50 to 80 bytes with their smallest doc_id, go to the
   buckets of their minimiser, shuffled only, never written as a table too. Copies of a segment are one before anything moves, so a line of a third of all documents costs one entry a slice. A hot minimiser's
   strings go one by one to the buckets of their own hashes, so that its many surroundings never meet in one bucket. Where much of the text is repeated, ranges of
   buckets take turns (PASS_TEXT), and each turn reads the slices anew: the disk that segments take stays bounded, at the cost of CPU time.
4. collection: a bucket's distinct segments are the multi-document collection. They are indexed column by column from the right: each round inserts one symbol of
   every text, and moves the transform and the common prefixes on (ColumnIndex). Segments without a common minimiser have no string in common, so a
   bucket is indexed in parts of about TOGETHER segments. Neighbours with a common prefix of `length` bytes are one string; its smallest doc_id goes back to the slices
   of its segments.
5. The slices mark what is covered. Positions are in the input, never in what is left.

A symbol is a block of several bytes (ten for strings of 50), numbered by its rank among those that occur, and a text enters once for each way to cut it into blocks from its right end, less what is left over; so every string of `length` bytes begins exactly one suffix. That takes a
tenth of the rounds. Which strings are equal, and so every removed byte, is read off the index; hashes only say what can be left out of it, and join exact copies of a
segment.

Null and empty texts have no bytes. A null doc_id counts as greater than any other. Rows of one doc_id do not remove each other.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinframe.llm.common import _byte_table, create, fresh_path, mix, remove as remove_path, run_hashes, shuffles_end, text_bytes, text_slices, written

LENGTH = 50
GRAM = 20
#: Bytes of text that one bucket answers for.
BUCKET_BYTES = 8 << 20
#: Slices that hold a minimiser, beyond which it is hot.
HOT_SLICES = 1024
#: Bytes of a symbol at most, and rows of a column that are in memory at a time.
SYMBOL, BLOCK = 10, 1 << 18
LAST = (1 << 63) - 1
SLICE = 1 << 20
#: Places whose grams are hashed at once, and segments that one index holds (more only if they share a minimiser).
STRETCH = 1 << 16
TOGETHER = 1536
#: Bytes of segments that are shuffled at a time, at most, as a multiple of the text, and bytes counted for a segment.
PASS_TEXT, SEGMENT_BYTES = 2.0, 80


def pack(*arrays: np.ndarray) -> bytes:
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return np.array([a.nbytes for a in arrays], "<i8").tobytes() + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, "<i8", len(kinds))
    body, at, out = zstandard.ZstdDecompressor().decompress(blob[8 * len(kinds) :]), 0, []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(body[at : at + size], kind))
        at += size
    return out


def planes(a: np.ndarray) -> np.ndarray:
    """The lowest bytes of all numbers, then the next lowest, and so on, which pack better than whole numbers."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).ravel()


def from_planes(data: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).ravel().view(kind)


def pack_segments(owner: np.ndarray, counts: np.ndarray, name: np.ndarray, wide: np.ndarray, data: np.ndarray) -> bytes:
    """The segments of a slice for a bucket: with many buckets there are few, so but four bytes stand before what is compressed."""
    body = np.concatenate([planes(owner.astype("<i8")), counts.astype("u1"), name.astype("u1"), wide.astype("u1"), data])
    return np.array([len(owner)], "<u4").tobytes() + zstandard.ZstdCompressor(level=1).compress(body.tobytes())


def unpack_segments(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4:]), np.uint8)
    return [from_planes(body[: 8 * n], "<i8"), body[8 * n : 9 * n], body[9 * n : 10 * n], body[10 * n : 11 * n], body[11 * n :]]


def slices(docs: DataFrame) -> DataFrame:
    """slice, size, body: the ids of its documents (8 bytes each), their borders, and their texts end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch, most=SLICE):
                data, offsets = text_bytes(rows.column(1))
                ids = rows.column(0).fill_null(LAST).to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.record_batch([pa.array([task << 32 | n]), pa.array([len(data)]), pa.array([pack(ids, offsets.astype("<i8"), data)], pa.binary())], ["slice", "size", "body"])
                n += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "slice long, size long, body binary")


def opened(body: bytes) -> list[np.ndarray]:
    return unpack(body, "<i8", "<i8", "u1")


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The hash of the gram at each place, by doubling."""
    with np.errstate(over="ignore"):
        at, width = _byte_table()[data], 1
        out, done = None, 0
        for bit in range(gram.bit_length()):
            if gram >> bit & 1:
                out = at if out is None else out[: len(out) - width] * np.uint64(0x9E3779B97F4A7C15) + at[done : done + len(out) - width]
                done += width
            if gram >> bit + 1:
                at = (at[:-width] ^ (at[:-width] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + at[width:]
                width *= 2
        return mix(out)


def minimisers(data: np.ndarray, cuts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of strings with one minimiser: their first start, number of strings, place and name (a hash) of the minimiser, and document (by number)."""
    n, span = len(data) - length + 1, length - gram + 1
    found = []
    for at in range(0, max(0, n), STRETCH):
        hashes = gram_hashes(data[at : min(at + STRETCH, n) + length - 1], gram)
        keyed = hashes & np.uint64((1 << 64) - (1 << 20)) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            keyed = np.minimum(keyed[:-width], keyed[width:])
            width *= 2
        here = min(STRETCH, n - at)
        place = (np.minimum(keyed[:here], keyed[span - width : span - width + here]) & np.uint64((1 << 20) - 1)).astype(np.int64)
        new = np.flatnonzero(np.diff(place, prepend=-1))
        # least hashes crowd at the low end: scrambled again, they spread over all buckets
        found.append((new + at, place[new] + at, mix(hashes[place[new]], 21)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    first, place, names = (np.concatenate(x) for x in zip(*found, strict=True))
    same = np.append(False, place[1:] == place[:-1])
    first, place, names = first[~same], place[~same], names[~same]
    # runs end where their document does; strings that would cross into the next one do not count
    last = cuts[1:] - length + 1
    begin = cuts[:-1][last > cuts[:-1]]
    starts = np.sort(np.concatenate([first, begin]), kind="stable")  # two sorted runs
    starts = starts[np.diff(starts, prepend=-1) > 0]
    doc = np.searchsorted(cuts, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], n), last[doc])
    keep = ends > starts
    starts, doc, ends = starts[keep], doc[keep], ends[keep]
    run = np.searchsorted(first, starts, side="right") - 1
    return starts, ends - starts, place[run], names[run], doc


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hashes' upper 32 bits, so sorted hashes have their buckets in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def distinct_anchors(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, sorted, and whether each occurs in several documents here."""
    by = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[by], doc[by]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return hashes, np.zeros(0, bool)
    return hashes[at], np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)


def _six(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def anchor_bits(packed: DataFrame, buckets: int, length: int, gram: int, hot_slices: int = HOT_SLICES) -> DataFrame:
    """slice, bucket, bits: for the slice's distinct anchors of the bucket, in order, whether they occur in several documents of the corpus, and then whether they are hot."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, _, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, cuts, data = opened(body)
                _, _, _, hashes, doc = minimisers(data, cuts, length, gram)
                hashes, several = distinct_anchors(hashes, doc)
                owner = bucket_of(hashes, buckets)
                some = np.unique(owner)
                lo, hi = np.searchsorted(owner, some), np.searchsorted(owner, some, side="right")
                yield pa.record_batch(
                    [pa.array(some), pa.array(np.full(len(some), name)), pa.array([_six(hashes[a:b]).tobytes() for a, b in zip(lo, hi, strict=True)], pa.binary()), pa.array([np.packbits(several[a:b]).tobytes() for a, b in zip(lo, hi, strict=True)], pa.binary())],
                    ["bucket", "slice", "hashes", "several"],
                )

    def answer(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in rows["hashes"].to_pylist()]
        sizes = [len(p) for p in parts]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, :6] = np.concatenate(parts)
        _, at, count = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["several"].to_pylist(), sizes, strict=True)]) > 0
        many = count > 1
        many[at[several]] = True
        bits, hot, ends = many[at], (count > hot_slices)[at], np.cumsum([0, *sizes])
        return pa.table([rows["slice"], rows["bucket"], pa.array([np.packbits([bits[a:b], hot[a:b]]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], ["slice", "bucket", "bits"])

    sent = packed.mapInArrow(send, "bucket long, slice long, hashes binary, several binary")
    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(answer, "slice long, bucket long, bits binary")


def known_files(bits: DataFrame, folder: str) -> tuple[dict[int, str], int]:
    """What the buckets answered, in the shared folder: a file for the slices of each task of slices(), by that task's number; and how many anchors occur in several documents, slice by slice.

    Slices that were shuffled to meet their answers would lie on disk twice.
    """

    def run(rows: pa.Table) -> pa.Table:
        fs, path = opened_folder(folder)
        name = f"known-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{path}/{name}") as out, pa.ipc.new_stream(out, rows.schema) as file:
            file.write_table(rows)
        found = 0
        for b in rows["bits"].to_pylist():
            bit = np.unpackbits(np.frombuffer(b, np.uint8))
            found += int(bit[: len(bit) // 2].sum())  # the first half, but for the bits that fill up the last byte
        return pa.table([pa.array([rows["slice"][0].as_py() >> 32]), pa.array([name]), pa.array([found])], ["task", "name", "found"])

    told = bits.groupBy(F.shiftright("slice", 32).alias("task")).applyInArrow(run, "task long, name string, found long").collect()
    return {r.task: r.name for r in told}, sum(r.found for r in told)


def segments(packed: DataFrame, folder: str, known: dict[int, str], buckets: int, length: int, gram: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """For each slice and bucket of this turn its distinct segments (blob), and for each slice (a bucket less than 0, in the order of turns) where they occur."""
    low, high = turn * buckets // turns, (turn + 1) * buckets // turns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened_folder(folder)
        held, by_slice = None, {}
        for batch in batches:
            for name, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name >> 32 != held:
                    held, by_slice = name >> 32, {}
                    if held in known:
                        with fs.open_input_stream(f"{path}/{known[held]}") as file, pa.ipc.open_stream(file) as rows:
                            for r in rows.read_all().to_pylist():
                                by_slice.setdefault(r["slice"], []).append(r)
                yield table(name, *opened(body), by_slice.get(name, []))

    def table(slice_: int, ids: np.ndarray, cuts: np.ndarray, data: np.ndarray, answers: list[dict]) -> pa.RecordBatch:
        starts, counts, place, hashes, doc = minimisers(data, cuts, length, gram)
        anchors, _ = distinct_anchors(hashes, doc)
        owner = bucket_of(anchors, buckets)
        many, hot = np.zeros((2, len(anchors)), bool)
        for a in answers:
            lo, hi = np.searchsorted(owner, (a["bucket"], a["bucket"] + 1))
            many[lo:hi], hot[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=2 * (hi - lo)).reshape(2, -1) > 0
        which = np.searchsorted(anchors, hashes) if len(anchors) else np.zeros(0, np.int64)
        # a hot minimiser's strings have buckets of their own, of any turn
        keep = (many & (hot | (owner >= low) & (owner < high)))[which] if len(anchors) else np.zeros(0, bool)
        starts, counts, place, hashes, doc = starts[keep], counts[keep], place[keep], hashes[keep], doc[keep]
        # what names a segment's group: its minimiser, or the whole string where that is hot
        name, wide = place - starts, np.full(len(starts), gram)
        if hot.any():
            single = hot[which[keep]]
            n = np.where(single, counts, 1)
            take = np.repeat(np.arange(len(starts)), n)
            inside = np.arange(len(take)) - np.repeat(np.cumsum(n) - n, n)
            single = single[take]
            starts, counts, hashes, doc = starts[take] + inside, np.where(single, 1, counts[take]), hashes[take], doc[take]
            name, wide = np.where(single, 0, name[take]), np.where(single, length, gram)
            hashes = hashes.copy()
            hashes[single] = mix(run_hashes(data, starts[single], starts[single] + length), 22)
            own = bucket_of(hashes, buckets)
            keep = (own >= low) & (own < high)
            starts, counts, name, wide, hashes, doc = (x[keep] for x in (starts, counts, name, wide, hashes, doc))
        content = run_hashes(data, starts, starts + counts + (length - 1))
        by = np.lexsort((ids[doc], content, bucket_of(hashes, buckets)))
        starts, counts, name, wide, hashes, doc, content = (x[by] for x in (starts, counts, name, wide, hashes, doc, content))
        new = np.ones(len(by), bool)
        new[1:] = content[1:] != content[:-1]
        at = np.flatnonzero(new)  # the first of each is the one with the smallest doc_id
        owner = bucket_of(hashes[at], buckets)
        some = np.unique(owner)
        names = [-1 - turn * buckets - int(mix(np.array([slice_]), 23)[0] % np.uint64(buckets))]
        blobs = [pack(np.packbits(new), planes(starts.astype("<u4")))]
        for b in some.tolist():
            lo, hi = np.searchsorted(owner, (b, b + 1))
            own = at[lo:hi]
            sizes = counts[own] + (length - 1)
            where = np.repeat(starts[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            names.append(b)
            blobs.append(pack_segments(ids[doc[own]], counts[own], name[own], wide[own], data[where]))
        return pa.record_batch([pa.array(np.full(len(names), slice_)), pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["slice", "bucket", "blob"])

    return packed.select("slice", "body").mapInArrow(run, "slice long, bucket long, blob binary")


class Columns:
    """The columns of an index, block by block, in one file that is written and read front to back; without a folder, in memory."""

    def __init__(self, kinds: tuple[str, ...], folder: str | None, block: int):
        self.kinds, self.block = [np.dtype(k) for k in kinds], block
        self.fs, self.path = opened_folder(folder) if folder else (None, "")
        self.path += f"/columns-{uuid.uuid4().hex}-"
        self.turn, self.sizes, self.blocks, self.out = 0, [], [], None

    def begin(self) -> None:
        """What is put from now on makes the next columns; blocks() still reads the ones before."""
        self.next_sizes, self.next_blocks, self.turn = [], [], self.turn + 1
        if self.fs:
            self.out = self.fs.open_output_stream(f"{self.path}{self.turn}")

    def put(self, *parts: np.ndarray) -> None:
        for at in range(0, len(parts[0]), self.block):
            piece = [np.ascontiguousarray(p[at : at + self.block], k) for p, k in zip(parts, self.kinds, strict=True)]
            self.next_sizes.append(len(piece[0]))
            if self.out:
                for p in piece:
                    self.out.write(p.data)
            else:
                self.next_blocks.append(piece)

    def end(self) -> None:
        if self.out:
            self.out.close()
            self.out = None
        self._drop(self.turn - 1)
        self.sizes, self.blocks = self.next_sizes, self.next_blocks

    def read(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """The place of each block's first row, and its columns. Between begin() and end(): those of the columns before."""
        at, turn = 0, self.turn - (self.out is not None)
        file = self.fs.open_input_stream(f"{self.path}{turn}") if self.fs and self.sizes else None
        for k, n in enumerate(self.sizes):
            yield at, [np.frombuffer(file.read(n * kind.itemsize), kind) for kind in self.kinds] if file else self.blocks[k]
            at += n
        if file:
            file.close()

    def _drop(self, turn: int) -> None:
        if self.fs and turn > 0:
            self.fs.delete_file(f"{self.path}{turn}")

    def close(self) -> None:
        self._drop(self.turn)
        self.sizes, self.blocks = [], []


def opened_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class ColumnIndex:
    """Burrows-Wheeler transform and common prefixes of many texts, built from the right, one symbol of each text a round.

    symbols: what the texts consist of, end to end; sizes: the texts' lengths, 255 at most. The transform holds, for each suffix so far in order, the number of the
    symbol before it (from 1; 0 where the text is used up). A suffix preceded by symbol c becomes the suffix that starts with c: the c's of the transform, in order, are
    the c-suffixes in order. So a new suffix stands where the symbols less than its own, and those equal to it before its old place, end. The common prefix of two
    neighbouring c-suffixes is one more than the least common prefix between the two places they came from; it has to be found for new suffixes and those right after
    them. Ends of texts differ from each other and precede every symbol.

    A round reads the columns (transform, prefixes, owners) twice, front to back: to find the places, and to write the next columns with the new rows in them. In memory
    are one block, a few values for each symbol, and one for each text.
    """

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, folder: str | None = None, block: int = BLOCK):
        self.n, self.sizes, self.ends = len(sizes), sizes, np.cumsum(sizes)
        self.values, number = np.unique(symbols, return_inverse=True)
        self.symbols = (number + 1).astype(np.uint16 if len(self.values) < 65535 else np.uint32)
        self.columns = Columns((self.symbols.dtype.str, "u1", "<i4" if self.n < 1 << 23 else "<i8"), folder, block)
        self.columns.begin()
        self.columns.put(self._before(np.arange(self.n), 0), np.zeros(self.n, np.uint8), np.arange(self.n) << 8)
        self.columns.end()
        fresh = np.flatnonzero(sizes > 0)
        for done in range(1, int(sizes.max(initial=0)) + 1):
            fresh = self._round(fresh, done)

    def _before(self, text: np.ndarray, done: int) -> np.ndarray:
        """The number of the symbol before the last `done` symbols of the texts; 0 where there is none."""
        out = np.zeros(len(text), self.symbols.dtype)
        left = self.sizes[text] > done
        out[left] = self.symbols[(self.ends[text] - done - 1)[left]]
        return out

    def _places(self, fresh: np.ndarray) -> tuple[np.ndarray, ...]:
        """The places of the new suffixes and their texts; the places of all whose common prefix is found anew, and that prefix."""
        m = len(self.values) + 1
        count, since, last_new = np.zeros(m, np.int64), np.full(m, 255, np.uint8), np.zeros(m, bool)
        turned, total, zeros = [], sum(self.columns.sizes), 0
        for at, (symbols, prefixes, owners) in self.columns.read():
            n = len(symbols)
            marked = np.zeros(n, bool)
            lo, hi = np.searchsorted(fresh, (at, at + n))
            marked[fresh[lo:hi] - at] = True
            order = np.argsort(symbols, kind="stable")
            number = symbols[order]
            used = int(np.searchsorted(number, 1))
            order, number, zeros = order[used:], number[used:], zeros + used
            if not len(order):
                since = np.minimum(since, prefixes.min())
                continue
            opens = np.ones(len(number), bool)
            np.not_equal(number[1:], number[:-1], out=opens[1:])
            first, is_new = np.flatnonzero(opens), marked[order]
            # a row's prefix is found anew if it or the one before it (of its number) is new
            turn = is_new.copy()
            turn[1:] |= is_new[:-1] & ~opens[1:]
            turn[first] |= last_new[number[first]]
            turn = np.flatnonzero(turn)
            own, opened = number[turn], opens[turn]
            rank = turn - first[np.cumsum(opens)[turn] - 1] + count[own]
            place = order[turn]
            least, start = _minima(prefixes), np.where(opened, 0, order[turn - 1] + 1)
            prefix = least(start, place + 1)
            prefix = np.where(opened, np.minimum(prefix, since[own]), prefix)
            fresh_ = is_new[turn]
            turned.append((own, rank, prefix, fresh_, owners[place] >> 8))
            # what the next block has to know of each number: how many, whether its last row is new, the least prefix since
            names, last = number[first], np.append(first[1:], len(number)) - 1
            count[names] += last - first + 1
            if at + n < total:
                last_new[names] = is_new[last]
                since = np.minimum(since, prefixes.min())
                begin = np.minimum(order[last] + 1, n - 1)
                since[names] = np.where(order[last] + 1 < n, least(begin, np.full(len(begin), n)), 255)
        below = np.cumsum(count) - count  # rows of lesser symbols
        own, rank, prefix, is_new, text = (np.concatenate(x) for x in zip(*turned, strict=True))
        place = below[own] + rank + self.n
        if len(turned) > 1:
            by = np.argsort(place)
            place, rank, prefix, is_new, text = (x[by] for x in (place, rank, prefix, is_new, text))
        return place[is_new], text[is_new].astype(np.int64), place, np.where(rank > 0, np.minimum(prefix, 254) + 1, 0)

    def _round(self, fresh: np.ndarray, done: int) -> np.ndarray:
        """fresh: the places of the suffixes of `done` - 1 symbols that have a symbol before them, in order. Inserts those of `done`; returns their places that go on."""
        slots, text, turned, prefix = self._places(fresh)
        symbols, owners = self._before(text, done), text << 8 | done
        ahead = slots - np.arange(len(slots))  # old rows before each new one
        self.columns.begin()
        at = used = 0
        for begin, old in self.columns.read():
            last = begin + len(old[0]) == sum(self.columns.sizes)
            to = len(slots) if last else int(np.searchsorted(ahead, begin + len(old[0])))
            total = len(old[0]) + to - used
            where = slots[used:to] - at
            kept = np.ones(total, bool)
            kept[where] = False
            out = []
            for column, rows in zip(old, (symbols, None, owners), strict=True):
                wide = np.empty(total, column.dtype)
                wide[kept] = column
                if rows is not None:
                    wide[where] = rows[used:to]
                out.append(wide)
            lo, hi = np.searchsorted(turned, (at, at + total))
            out[1][turned[lo:hi] - at] = prefix[lo:hi]
            self.columns.put(*out)
            at, used = at + total, to
        self.columns.end()
        return slots[symbols > 0]

    def close(self) -> None:
        self.columns.close()


def _minima(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives the least value of each range from lo to hi (exclusive, not empty), from the least of every 1, 2, 4, ... neighbours."""
    n = len(values)
    level = np.zeros(n + 1, np.uint8)
    for k in range(1, n.bit_length()):
        level[1 << k :] = k
    table = np.empty((n.bit_length(), n), np.uint8)
    table[0] = values
    for k in range(1, len(table)):
        width = 1 << k - 1
        np.minimum(table[k - 1, : n - width], table[k - 1, width:], out=table[k, : n - width])
    flat = table.ravel()

    def least(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        at = level[hi - lo].astype(np.int64)
        row = at * n
        return np.minimum(flat[row + lo], flat[row + hi - (1 << at)])

    return least


def _blocks(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit number for the block of `width` bytes at each place, equal for equal blocks only: the bytes themselves, or the ranks of two halves."""
    n = len(data) - width + 1
    if width <= 8:
        value = np.zeros(max(0, n), np.uint64)
        for k in range(width):
            value <<= np.uint64(8)
            value |= data[k : n + k]
        return value
    half = width // 2
    rank = np.unique(_blocks(data, half), return_inverse=True)[1].astype(np.uint64)
    value = rank[:n] << np.uint64(32) | rank[half : n + half]
    return value


def _cut(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The texts as blocks of symbols: symbols end to end and their number a text; each such text's source, and the bytes left over at its right end."""
    width = max(w for w in range(1, SYMBOL + 1) if length % w == 0 and (w <= 8 or w % 2 == 0))
    value = _blocks(data, width)
    ways = np.minimum(width, sizes - length + 1)
    source = np.repeat(np.arange(len(sizes)), ways)
    over = np.arange(len(source)) - np.repeat(np.cumsum(ways) - ways, ways)
    count = (sizes[source] - over) // width
    ends = np.cumsum(sizes)[source] - over
    begin = np.repeat(ends - count * width, count)
    inside = np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count)
    return value[begin + inside * width], count, source, over, width


def least_owners(data: np.ndarray, sizes: np.ndarray, owner: np.ndarray, length: int, folder: str | None = None, block: int = BLOCK) -> np.ndarray:
    """For each string of `length` bytes of the texts, text by text in order of place: the least owner of a text that holds it."""
    counts = sizes - length + 1
    out, first = np.empty(int(counts.sum()), np.int64), np.cumsum(counts) - counts
    symbols, count, source, over, width = _cut(data, sizes, length)
    index = ColumnIndex(symbols, count, folder, block)
    try:
        # suffixes of a string's length or more, in order; equal strings are neighbours
        groups, rows, group = [], [], 0
        for _, (_, prefixes, owners) in index.columns.read():
            starts = group + np.cumsum(prefixes < length // width)
            group = int(starts[-1])
            long = np.flatnonzero((owners & 255) >= length // width)
            groups.append(starts[long])
            rows.append(owners[long].astype(np.int64))
    finally:
        index.close()
    if not rows or not sum(map(len, rows)):
        return out
    group, row = np.concatenate(groups), np.concatenate(rows)
    text, size = source[row >> 8], (row & 255) * width + over[row >> 8]
    at = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.repeat(np.minimum.reduceat(owner[text], at), np.diff(np.append(at, len(group))))
    out[first[text] + sizes[text] - size] = least
    return out


def _together(group: np.ndarray) -> Iterator[slice]:
    """Stretches of sorted groups, of TOGETHER entries or few more; no group is cut."""
    at = 0
    while at < len(group):
        end = min(at + TOGETHER, len(group))
        end = int(np.searchsorted(group, group[end - 1], side="right"))
        yield slice(at, end)
        at = end


def answers(sent: DataFrame, buckets: int, length: int, folder: str | None = None, block: int = BLOCK) -> DataFrame:
    """For each slice and bucket, in the order of its segments: runs of strings and their least doc_id (blob). What is for no bucket passes."""

    def run(rows: pa.Table) -> pa.Table:
        if rows["bucket"][0].as_py() < 0:
            return rows.select(["slice", "bucket", "blob"])
        parts = [unpack_segments(b) for b in rows["blob"].to_pylist()]
        owner, sizes, name, wide, data = (np.concatenate([p[k] for p in parts]) for k in range(5))
        sizes, name, wide = sizes.astype(np.int64) + (length - 1), name.astype(np.int64), wide.astype(np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        content = run_hashes(data, starts, ends)
        _, first, which = np.unique(content, return_index=True, return_inverse=True)
        own = np.full(len(first), LAST)
        np.minimum.at(own, which, owner)
        counts = sizes[first] - length + 1
        least = np.empty(int(counts.sum()), np.int64)
        group = run_hashes(data, starts[first] + name[first], starts[first] + name[first] + wide[first])
        by = np.argsort(group, kind="stable")
        at = np.cumsum(counts) - counts
        for some in _together(group[by]):
            own_at, take = by[some], first[by[some]]
            where = np.repeat(starts[take] - np.cumsum(sizes[take]) + sizes[take], sizes[take]) + np.arange(sizes[take].sum())
            target = np.repeat(at[own_at] - np.cumsum(counts[own_at]) + counts[own_at], counts[own_at]) + np.arange(counts[own_at].sum())
            least[target] = least_owners(data[where], sizes[take], own[own_at], length, folder, block)
        # runs of equal answers within each distinct segment
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[at] = True
        at_run = np.flatnonzero(new)
        run_size, run_least = np.diff(np.append(at_run, len(least))), least[at_run]
        first_run = np.searchsorted(at_run, at)
        n_runs = np.diff(np.append(first_run, len(at_run)))
        blobs, done = [], 0
        for p in parts:
            w = which[done : done + len(p[0])]
            done += len(p[0])
            take = np.repeat(first_run[w] - np.cumsum(n_runs[w]) + n_runs[w], n_runs[w]) + np.arange(n_runs[w].sum())
            blobs.append(pack(n_runs[w].astype("u1"), run_size[take].astype("u1"), run_least[take].astype("<i8")))
        return pa.table([rows["slice"], rows["bucket"], pa.array(blobs, pa.binary())], ["slice", "bucket", "blob"])

    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, "slice long, bucket long, blob binary")


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_bytes: bool = True, buckets: int | None = None, block: int = BLOCK, hot_slices: int = HOT_SLICES, turns: int | None = None) -> DataFrame:
    """doc_id, n_bytes, spans (removed byte intervals, maximal), kept_sha256 and, with keep_bytes, kept (the remaining bytes) of every row of docs.

    turns: ranges of buckets whose segments are shuffled one after the other; by default as many as keep them within PASS_TEXT times the text.
    length may be up to 128 and at least 2 * gram; a gram is at least 8 bytes.
    """
    if not 8 <= gram <= length // 2 <= 64:
        raise ValueError("8 <= gram <= length / 2 <= 64")
    spark = docs.sparkSession
    packed = written(slices(docs), "slices")
    total = packed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    folder = fresh_path(spark, "columns")  # goes whole, with what lost tasks leave there
    create(spark, folder)
    with shuffles_end(spark):
        known, repeated = known_files(anchor_bits(packed, buckets, length, gram, hot_slices), folder)
    turns = turns or min(buckets, max(1, math.ceil(repeated * SEGMENT_BYTES / (PASS_TEXT * max(1, total)))))
    found = []
    for turn in range(turns):
        sent = segments(packed, folder, known, buckets, length, gram, turn, turns)
        found.append(written(answers(sent, -(-buckets // turns), length, folder, block), "answers"))
    remove_path(spark, folder)
    told = reduce(DataFrame.unionByName, found).groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("bucket", "blob"))).alias("told"))
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # what occurs where comes first, the last turn before the others
                yield marked(*opened(body), [t["blob"] for t in told if t["bucket"] < 0][::-1], [t["blob"] for t in told if t["bucket"] >= 0])

    def marked(ids: np.ndarray, cuts: np.ndarray, data: np.ndarray, occurs: list[bytes], told: list[bytes]) -> pa.RecordBatch:
        delta = np.zeros(len(data) + 1, np.int64)
        if told:
            places, entry, known = [], [], 0
            for blob in occurs:
                new, starts = unpack(blob, "u1", "u1")
                places.append(from_planes(starts, "<u4").astype(np.int64))
                entry.append(known - 1 + np.cumsum(np.unpackbits(new, count=len(places[-1])), dtype=np.int64))
                known += int(np.bitwise_count(new).sum())
            starts, entry = np.concatenate(places), np.concatenate(entry)
            doc = np.searchsorted(cuts, starts, side="right") - 1
            parts = [unpack(blob, "u1", "u1", "<i8") for blob in told]
            n_runs, size, least = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3))
            begin = np.cumsum(size) - size
            first = np.cumsum(n_runs) - n_runs
            n = n_runs[entry]
            take = np.repeat(first[entry] - np.cumsum(n) + n, n) + np.arange(n.sum())
            begin = begin[take] - np.repeat(begin[first[entry]], n) + np.repeat(starts, n)
            gone = least[take] < np.repeat(ids[doc], n)
            np.add.at(delta, begin[gone], 1)
            np.add.at(delta, (begin + size[take] + length - 1)[gone], -1)
        covered = np.cumsum(delta[:-1]) > 0
        from twinframe.llm.common import runs

        lo, hi = runs(covered, cuts)
        span_at = np.searchsorted(lo, cuts)
        spans, shas, kept = [], [], []
        for r in range(len(ids)):
            a, b = int(cuts[r]), int(cuts[r + 1])
            x, y = int(span_at[r]), int(span_at[r + 1])
            spans.append([{"a": int(p) - a, "b": int(q) - a} for p, q in zip(lo[x:y], hi[x:y], strict=True)])
            left = (data[a:b][~covered[a:b]] if y > x else data[a:b]).tobytes()
            shas.append(hashlib.sha256(left).hexdigest())
            if keep_bytes:
                kept.append(left)
        names = [None if i == LAST else int(i) for i in ids]
        arrays = [pa.array(names, pa.int64()), pa.array(np.diff(cuts)), pa.array(spans, kind), pa.array(shas, pa.string())]
        return pa.record_batch([*arrays, *([pa.array(kept, pa.binary())] if keep_bytes else [])], ["doc_id", "n_bytes", "spans", "kept_sha256", *(["kept"] if keep_bytes else [])])

    schema = "doc_id long, n_bytes long, spans array<struct<a:long,b:long>>, kept_sha256 string" + ", kept binary" * keep_bytes
    return packed.join(told, "slice").select("body", "told").mapInArrow(run, schema)


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["b"] - s["a"])
    return remove(docs, length, keep_bytes=False).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
