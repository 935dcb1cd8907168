"""Token ids as ORC files: integer run-length encoding, row indexes, and Bloom filters on document ids.

Documents are dealt by ranges of doc_id and sorted in them, encoded after the shuffle (so the text moves, once, and nothing is encoded for
the range sample), and written as array<int>. ORC's integer columns are run-length encoded in stripes; each stripe is an independent unit
of reading, its row index holds the least and greatest doc_id of every `row_index_stride` rows, and a Bloom filter on doc_id lets a
point lookup skip the groups that cannot hold it. Each row also holds its file's number and its own place in the file, so the order of the
whole is read from the files and never from their names (which sort wrongly from the 100,000th on).

A null or empty text is the end id alone. Rows of equal doc_id stay next to each other, in an order fixed by their texts' hashes, and may be
dealt to several files; a null doc_id comes first.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from twinframe.llm.common import map_slices, text_slices, written

END_ID = 2
_FILE = "doc_id long, ids array<int>, part int, row long"
#: Distinct words of which each generation of a worker's memory holds the ids.
CACHE_ENTRIES = 300_000
#: Longer words are encoded each time.
CACHED_CHARS = 48
# The tokenizer's own pattern, spelled out for code points below U+0250. Letters stand first: alternatives that begin alike keep their order.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t\n\v\f\r \x85\xa0"
_WORD = re.compile(f"[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
_ASCII_WORD = re.compile(r"[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t\n\v\f\r a-z0-9]+")
# All but what is spelled out and stays so in lower case (U+0130 and 23 capitals have small letters of two code points or at U+0253 or above).
_OTHER = re.compile(f"[^{''.join(re.escape(c) for c in map(chr, range(0x250)) if len(c.lower()) == 1 and c.lower() <= chr(0x24F))}]")


class Remembered(dict):
    """A bounded memory of two generations: what is used again outlives the turn of a generation, the rest goes."""

    def __init__(self, entries: int):
        self.entries, self.old = entries, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old[key]
        self[key] = value
        return value

    def lacks(self, keys: set[str]) -> list[str]:
        """Those of keys that neither generation holds; a full one turns."""
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        return list(keys.difference(self, self.old))


def _is_latin(text: str) -> bool:
    """Whether all code points lie below U+0100, where lower case stays."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids of texts, as little-endian 32-bit integers, word by word.

    A text whose code points are all below U+0250, and stay one each and below it in lower case, is its own normal form once lower-cased, and the tokenizer's pattern can be
    stepped through here. Its words' ids are remembered; those of the slice that are not remembered go to the library in one call, joined by spaces, and
    are told apart by the tokens that end a word. The library splits such a list at its spaces only. Any other text goes to the library as it is.
    """

    def __init__(self, path: str):
        self.tokenizer, self.words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words.encode_special_tokens = True
        self.known = Remembered(CACHE_ENTRIES)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        parts = [self.split(t) for t in texts]
        fresh = self._together(self.known.lacks(set().union(*(p for p in parts if isinstance(p, list)))))
        long = {w: ids for w, ids in fresh.items() if len(w) > CACHED_CHARS}
        for w in long:
            del fresh[w]
        self.known.update(fresh)
        get = self.known.__getitem__ if not long else lambda w: long[w] if w in long else self.known[w]
        return [b"".join(map(get, p)) if isinstance(p, list) else self._whole(p) for p in parts]

    @staticmethod
    def split(text: str | None) -> list[str] | str:
        """The words of a text, or the text where it has to go to the library whole."""
        if not text or "<|" in text:
            return text or []
        if text.isascii():
            return _ASCII_WORD.findall(text.lower())
        if not _is_latin(text) and _OTHER.search(text):
            return text
        return _WORD.findall(text.lower())

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str]) -> dict[str, bytes]:
        if not words:
            return {}
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return {w: self._whole(w) for w in words}
        raw, at, out = ids.tobytes(), 0, {}
        for w, end in zip(words, (ends * 4).tolist(), strict=True):
            out[w] = raw[at:end]
            at = end
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encoded(rows: pa.RecordBatch, tokenizer_file: str, close: bytes) -> list[pa.Array]:
    ids = word_encoder(tokenizer_file)(rows.column(1).to_pylist())
    ends = np.cumsum([0, *(len(x) // 4 + 1 for x in ids)]).astype(np.int32)
    flat = np.frombuffer(b"".join(x + close for x in ids), "<i4")
    return [rows.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]


def encode(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and ids (array<int>) of every row of docs, each closed by end_id."""
    close = np.array([end_id], "<u4").tobytes()

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch(_encoded(rows, tokenizer_file, close), ["doc_id", "ids"])

    return map_slices(docs, ["doc_id", "text"], step, "doc_id long, ids array<int>")


def write(docs: DataFrame, tokenizer_file: str, path: str, partitions: int | None = None, end_id: int = END_ID, stripe_bytes: int = 16 << 20, row_index_stride: int = 1000) -> None:
    """Writes the ids of docs to ORC files at path, ascending by doc_id over the files in order of their names."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(n, *order).sortWithinPartitions(*order)
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": str(row_index_stride), "orc.stripe.size": str(stripe_bytes), "compression": "zstd"}
    numbered(dealt, tokenizer_file, end_id).write.options(**options).orc(path)


def numbered(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """encode() with part (the number of the row's task, which is its file's) and row (its place in the task's order), in one Python worker."""
    close = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch):
                n = rows.num_rows
                yield pa.record_batch([*_encoded(rows, tokenizer_file, close), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], ["doc_id", "ids", "part", "row"])
                at += n

    return docs.select("doc_id", "text").mapInArrow(run, _FILE)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids, part and row: the documents' order is that of (part, row). Stripes are read in parallel."""
    return spark.read.schema(_FILE).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of a few documents; stripes and row groups are pruned by their statistics and Bloom filters."""
    return read(spark, path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (ids as little-endian unsigned 32-bit integers)."""
    schema = "doc_id long, part int, row long, n_tokens long, ids_crc32 long"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids = rows.column(1)
            ends = ids.offsets.to_numpy().astype(np.int64)
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.record_batch([rows.column(0), rows.column(2), rows.column(3), pa.array(np.diff(ends)), pa.array(crc, pa.int64())], ["doc_id", "part", "row", "n_tokens", "ids_crc32"])

    rows = written(read(spark, path).mapInArrow(step, schema), "id-index")
    # Two levels of prefix sums: rows in their file, then files; the second has one row for each file.
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    files = files.select(F.col("part").alias("_part"), (F.sum("_sum").over(Window.orderBy("part")) - F.col("_sum")).alias("_before"))
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_upto", F.sum("n_tokens").over(within))
    return summed.join(files, F.col("part") == F.col("_part")).select("doc_id", (F.col("_before") + F.col("_upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
