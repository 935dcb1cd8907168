"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

A text is lower-cased (A-Z only) and read as its words: maximal runs of 0-9, a-z and all code points from U+0080. A window is `window`
consecutive words of one item; an item of fewer words is one window by itself, an item without words has none. Document words stream
through the automaton, which keeps the length of the longest match that ends at each word; a word inside any occurrence of a window is hit.

A vectorised first look keeps only stretches in which every word is an item's word and every pair of neighbours is a pair of some item.
Every occurrence of a window lies in such a stretch, so the automaton sees all of them. Nothing of the documents is shuffled: the automata go to them.

Items are dealt by their ids to parts of about PART_BYTES of text. Each part's automaton is built in a task of its own and packed into arrays, in time
and space linear in its words (some 10 bytes of arrays for each byte of text): only states of windows, and of whole shorter items, hold items. A worker scans a
document's words with all parts of a pass one after another; up to MAX_ITEM_BYTES of items are one pass. Only beyond, where the automata would no longer fit a
worker, the documents pass again, and findings join those of earlier passes in the row. Coverage is decided and texts are cut once, on all findings.

Null and empty texts have no words and are never hit; items with null ids or texts are ignored; equal items with different ids all count.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from twinframe.llm.common import drop_written, lower_ascii, map_slices, run_hashes, runs, text_bytes, written

WINDOW = 10
#: Bytes of item text that one automaton holds (a longer item stands alone), and that a worker holds automata of.
PART_BYTES, MAX_ITEM_BYTES = 1 << 20, 16 << 20
_SPANS, _ITEMS = "__twinframe_spans", "__twinframe_items"
_SPAN_LIST = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


class ItemAutomaton:
    """Suffix automaton over the word sequences of many items, with the items of each window's state, in flat arrays."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.window = window
        self.ids = [i for i, _ in items]
        vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [[vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)] for _, t in items]
        for seq in sequences:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        self.words = len(vocabulary)
        holders, owners = self._holders(sequences)
        by = np.lexsort((owners, holders))
        self.first = np.searchsorted(holders[by], np.arange(len(self.link) + 1)).astype(np.int32)
        self.owners = owners[by].astype(np.int32)
        self._fold(np.unique(holders[np.array(self.length, np.int64)[holders] < window]) if len(holders) else np.zeros(0, np.int64))
        counts = [min(window, len(x)) for x in sequences if x]
        self.least = min(counts, default=0)
        pairs = [np.array(x[:-1], np.int64) * self.words + np.array(x[1:], np.int64) for x in sequences if len(x) > 1]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
        self._name(list(vocabulary))

    def _holders(self, sequences: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """State and item of every window, and of every whole shorter item: no more of them than words."""
        holders, owners = [], []
        for k, seq in enumerate(sequences):
            at = size = 0
            for word in seq:
                at, size = self.next[at][word], size + 1
                # the state of the last `window` words only, so that a step goes up as far as steps went down
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                if size >= self.window:
                    holders.append(at)
                    owners.append(k)
            if 0 < size < self.window:
                holders.append(at)
                owners.append(k)
        pair = np.unique(np.stack([np.array(holders, np.int64), np.array(owners, np.int64)]), axis=1)
        return pair[0], pair[1]

    def _fold(self, short: np.ndarray) -> None:
        """Transitions, links and lengths as arrays. short: the states whose longest string is a whole short item."""
        n = len(self.link)
        length, link = np.array(self.length, np.int32), np.array(self.link, np.int32)
        whole = np.zeros(n, bool)
        whole[short] = True
        holder, up = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        for v in np.argsort(length, kind="stable")[1:].tolist():
            above = int(link[v])
            holder[v] = holder[above] if length[above] >= self.window else v
            up[v] = v if whole[v] else up[above]
        sizes = np.fromiter(map(len, self.next), np.int64, n)
        symbol = np.fromiter((w for step in self.next for w in step), np.int64, int(sizes.sum()))
        target = np.fromiter((v for step in self.next for v in step.values()), np.int32, int(sizes.sum()))
        keys = np.repeat(np.arange(n), sizes) * self.words + symbol
        by = np.argsort(keys)
        self.keys, self.target = keys[by], target[by]
        self.next, self.link, self.length, self.holder, self.short_up = None, link, length, holder, up

    def _name(self, names: list[bytes]) -> None:
        size = np.fromiter(map(len, names), np.int64, len(names))
        ends = np.cumsum(size)
        hashes = run_hashes(np.frombuffer(b"".join(names), np.uint8), ends - size, ends) if names else np.zeros(0, np.uint64)
        by = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[by], by
        self.names, self.ends = b"".join(names), ends

    def _word(self, k: int) -> bytes:
        return self.names[self.ends[k - 1] if k else 0 : self.ends[k]]

    def _extend(self, last: int, word: int) -> int:
        have = self.next[last].get(word)
        if have is not None:
            if self.length[have] == self.length[last] + 1:
                return have
            return self._clone(last, word, have)
        new = len(self.link)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            below = self.next[at][word]
            self.link[new] = below if self.length[below] == self.length[at] + 1 else self._clone(at, word, below)
        return new

    def _clone(self, at: int, word: int, of: int) -> int:
        new = len(self.link)
        self.next.append(dict(self.next[of]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[of])
        self.link[of] = new
        while at >= 0 and self.next[at].get(word) == of:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The words' numbers by their hashes; -1 for other words."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.hash_ids[at], -1)

    def scan(self, words: list[bytes], numbers: np.ndarray | None = None) -> Iterator[tuple[int, int, list[int]]]:
        """(first word, end word, items) of every window occurrence in a run of words, by its last word."""
        if numbers is None:
            size = np.fromiter(map(len, words), np.int64, len(words))
            numbers = self.numbers(run_hashes(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, np.cumsum(size)))
        keys, target, link, length, up_of, holder, first = map(memoryview, (self.keys, self.target, self.link, self.length, self.short_up, self.holder, self.first))
        state = matched = 0
        n = len(keys)

        def step(at: int, word: int) -> int:
            key = at * self.words + word
            k = bisect_left(keys, key)
            return target[k] if k < n and keys[k] == key else -1

        for i, (name, word) in enumerate(zip(words, numbers.tolist(), strict=True)):
            if word < 0 or self._word(word) != name:  # equal hashes of unequal words are told apart
                state = matched = 0
                continue
            to = step(state, word)
            while to < 0 and state:
                state = link[state]
                matched = length[state]
                to = step(state, word)
            if to >= 0:
                state, matched = to, matched + 1
            if matched >= self.window:
                h = holder[state]
                yield i + 1 - self.window, i + 1, self.owners[first[h] : first[h + 1]].tolist()
            up = up_of[state]
            while up > 0:
                if length[up] <= matched:
                    yield i + 1 - length[up], i + 1, self.owners[first[up] : first[up + 1]].tolist()
                up = up_of[link[up]]

    _seen: np.ndarray | None = None

    def stretches(self, hashes: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of words (as positions) in which a window may occur, and their words' numbers."""
        if not self.least or not len(hashes):
            return
        if self._seen is None:
            self._seen = np.zeros(1 << 20, bool)
            self._seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        ids = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self._seen[(hashes >> np.uint64(44)).astype(np.int64)])
        ids[maybe] = self.numbers(hashes[maybe])
        known = ids >= 0
        joined = known[1:] & known[:-1] & (row[1:] == row[:-1])
        where = np.flatnonzero(joined)
        if len(where):
            code = ids[where] * self.words + ids[where + 1]
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1) if len(self.pairs) else None
            joined[where] = self.pairs[at] == code if at is not None else False
        # a stretch is a maximal run of known words whose neighbours are joined
        cut = np.flatnonzero(~np.concatenate([[False], joined, [False]]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if self.least < 2 else self._long(cut):
            if known[a]:
                yield a, b, ids[a:b]

    def _long(self, cut: np.ndarray) -> Iterator[tuple[int, int]]:
        wide = np.flatnonzero(np.diff(cut) >= self.least)
        return zip(cut[wide].tolist(), cut[wide + 1].tolist(), strict=True)


def _scan_rows(rows: pa.RecordBatch, autos: list[ItemAutomaton]) -> Iterator[tuple[int, list[tuple[int, int]], set[int], np.ndarray, np.ndarray]]:
    """For each row: its number of words, merged hit runs of words, ids of hit items, and byte borders of its words."""
    data, offsets = text_bytes(rows.column(rows.schema.get_field_index("text")))
    data = lower_ascii(data)
    starts, ends = runs(_IS_WORD[data], offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(starts, offsets)
    found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
    raw, hashes = data.tobytes(), run_hashes(data, starts, ends)
    for auto in autos:
        for a, b, numbers in auto.stretches(hashes, row):
            r = int(row[a])
            base = a - int(first[r])
            for lo, hi, items in auto.scan([raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)], numbers):
                spans, got = found.setdefault(r, ([], set()))
                spans.append((base + lo, base + hi))
                got.update(auto.ids[k] for k in items)
    for r in range(rows.num_rows):
        spans, got = found.get(r, ([], set()))
        x, y = int(first[r]), int(first[r + 1])
        yield y - x, merged(spans), got, starts[x:y] - offsets[r], ends[x:y] - offsets[r]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, window: int = WINDOW, part: int = PART_BYTES) -> DataFrame:
    """part, size (bytes of its items) and automaton (packed), each part built in a task of its own, in the shared folder."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // part))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))

    def build(rows: pa.Table) -> pa.Table:
        held = sorted(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True))
        size = sum(len(t.encode()) for _, t in held)
        return pa.table([rows["part"].slice(0, 1), pa.array([size]), pa.array([pickle.dumps(ItemAutomaton(held, window))], pa.binary())], ["part", "size", "automaton"])

    return written(dealt.groupBy("part").applyInArrow(build, "part long, size long, automaton binary"), "automata")


def passes(benchmark: DataFrame, window: int, part: int, most: int) -> Iterator[list[ItemAutomaton]]:
    """The automata, as many at a time as have `most` bytes of items; the driver holds those of one pass."""
    table = automata(benchmark, window, part)
    held, size = [], 0
    for row in table.orderBy("part").toLocalIterator():
        if held and size + row.size > most:
            yield held
            held, size = [], 0
        held.append(pickle.loads(row.automaton))
        size += row.size
    drop_written(table)
    yield held


def _all_hits(rows: pa.RecordBatch, autos: list[ItemAutomaton]) -> Iterator[tuple[int, list[tuple[int, int]], set[int], np.ndarray, np.ndarray]]:
    """_scan_rows, with what earlier passes found in the same texts."""
    n, names = rows.num_rows, rows.schema.names
    spans_before, items_before = (rows.column(names.index(c)).to_pylist() if c in names else [()] * n for c in (_SPANS, _ITEMS))
    for (words, spans, items, starts, ends), more, others in zip(_scan_rows(rows, autos), spans_before, items_before, strict=True):
        yield words, merged([*spans, *((s["a"], s["b"]) for s in more)]) if more else spans, items.union(others), starts, ends


def _span_lists(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"a": a, "b": b} for a, b in row] for row in spans], _SPAN_LIST)


def _up_to_last(docs: DataFrame, benchmark: DataFrame, window: int, part: int, most: int) -> tuple[DataFrame, Broadcast]:
    """docs with the findings of all passes but the last in _SPANS and _ITEMS (as they are where one pass does), and the last one's automata.

    Every pass reads the texts as they came, and rows stay rows. A table ends each pass, so a worker holds the automata of one.
    """
    span = StructType([StructField("a", LongType()), StructField("b", LongType())])
    schema = StructType([*docs.schema.fields, StructField(_SPANS, ArrayType(span)), StructField(_ITEMS, ArrayType(LongType()))])
    columns, last, table = docs.columns, None, None
    for shared in map(docs.sparkSession.sparkContext.broadcast, passes(benchmark, window, part, most)):
        if last is not None:

            def step(rows: pa.RecordBatch, last=last) -> pa.RecordBatch:
                got = list(_all_hits(rows, last.value))
                return pa.record_batch([*rows.columns[: len(columns)], _span_lists([g[1] for g in got]), pa.array([sorted(g[2]) for g in got], pa.list_(pa.int64()))], [*columns, _SPANS, _ITEMS])

            docs = written(map_slices(docs, docs.columns, step, schema), "scanned")
            if table is not None:
                drop_written(table)
            table = docs
            last.unpersist()
        last = shared
    return docs, last


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_ITEM_BYTES, part: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, spans (hit runs as array of word intervals) and items (ids with occurring windows) of every row of docs."""
    docs, shared = _up_to_last(docs.select("doc_id", "text"), benchmark, window, part, most)

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        got = list(_all_hits(rows, shared.value))
        return pa.record_batch(
            [rows.column(0), pa.array([g[0] for g in got], pa.int64()), _span_lists([g[1] for g in got]), pa.array([sorted(g[2]) for g in got], pa.list_(pa.int64()))],
            ["doc_id", "n_words", "spans", "items"],
        )

    return map_slices(docs, docs.columns, step, "doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<long>")


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_ITEM_BYTES, part: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (sorted ids as strings, comma-joined), contaminated, coverage, longest (words of the longest hit run)."""
    width = F.transform("spans", lambda s: s["b"] - s["a"])
    hit = F.aggregate(width, F.lit(0).cast("long"), lambda a, x: a + x)
    found = find(docs, benchmark, window, most, part)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.when(F.col("n_words") > 0, hit / F.col("n_words")).otherwise(F.lit(0.0)).alias("coverage"),
        F.coalesce(F.array_max(width), F.lit(0).cast("long")).alias("longest"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, most: int = MAX_ITEM_BYTES, part: int = PART_BYTES) -> DataFrame:
    """docs (same columns) without its hit spans; a document of which more than `max_coverage` of the words are hit goes whole.

    A span is cut from its first word's first byte to its last word's last byte and leaves the text around it as it was; n_chars, if there,
    is counted anew for changed texts. Coverage is decided, and texts are cut, once, on what all passes found.
    """
    columns, place = docs.columns, docs.columns.index("text")
    schema = docs.schema
    docs, shared = _up_to_last(docs, benchmark, window, part, most)

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        keep, texts, changed = [], [], []
        for r, (n, spans, _, starts, ends) in enumerate(_all_hits(rows, shared.value)):
            if not spans:
                keep.append(r)
                texts.append(rows.column(place)[r].as_py())
                changed.append(False)
            elif sum(b - a for a, b in spans) <= max_coverage * n:
                raw, out, at = rows.column(place)[r].as_py().encode(), [], 0
                for a, b in spans:
                    out.append(raw[at : starts[a]])
                    at = int(ends[b - 1])
                keep.append(r)
                texts.append(b"".join([*out, raw[at:]]).decode())
                changed.append(True)
        taken = rows.take(pa.array(keep, pa.int64()))
        arrays = list(taken.columns)[: len(columns)]
        arrays[place] = pa.array(texts, pa.string())
        if "n_chars" in columns and any(changed):
            k = columns.index("n_chars")
            old = taken.column(k).to_pylist()
            arrays[k] = pa.array([len(t) if c else o for t, c, o in zip(texts, changed, old, strict=True)], taken.column(k).type)
        return pa.record_batch(arrays, columns)

    return map_slices(docs, docs.columns, step, schema)


def digest(items: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
