"""Byte-level BPE encoding and decoding with a local rank file.

One worker holds one encoder for all its batches. A text is encoded whole; a long one is first cut before single spaces that stand
between two other non-space characters. No match of the pre-splitting pattern crosses such a place (a match holds a space only as its
first character or inside a run of white space), so the ids are those of the uncut text, with bounded memory for each call.

Nulls and empty texts have no ids and decode to nothing. Ids are those of ordinary text: control strings have no special meaning.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from twinframe.llm.common import map_slices

#: Code points after which a text is cut at the next safe place.
PIECE_CHARS = 1 << 16
_SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def encoder(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str | None, most: int = PIECE_CHARS) -> np.ndarray:
    """The ids of one text, as unsigned 32-bit integers."""
    if not text:
        return np.zeros(0, np.uint32)
    got = [enc.encode_to_numpy(p, disallowed_special=()) for p in pieces(text, most)]
    return (got[0] if len(got) == 1 else np.concatenate(got)).astype(np.uint32, copy=False)


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and ids (array<int>) of every row of docs; a null or empty text has no ids."""

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(rank_file, pattern)
        ids = [encode_text(enc, t) for t in rows.column(1).to_pylist()]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return pa.record_batch([rows.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    return map_slices(docs, ["doc_id", "text"], step, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and decoded (binary): the raw bytes of ids. They need not be valid UTF-8 when ids were cut."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for rows in batches:
            raw = [enc.decode_bytes(ids or []) for ids in rows.column(1).to_pylist()]
            yield pa.record_batch([rows.column(0), pa.array(raw, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(step, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """Encodes every text, decodes the ids again, and returns the digests of both beside the columns in `keep`.

    Columns: keep (doc_id by default), n_tokens, n_bytes (decoded), ids_sha256 (ids as little-endian unsigned 32-bit integers),
    decoded_sha256, lossless (whether the decoded bytes are the text's).
    """
    keep = keep or ["doc_id"]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def step(rows: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(rank_file, pattern)
        n, size, ids_sha, raw_sha, same = [], [], [], [], []
        for text in rows.column(len(keep)).to_pylist():
            ids = encode_text(enc, text)
            raw = enc.decode_bytes(ids.tolist())
            n.append(len(ids))
            size.append(len(raw))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            raw_sha.append(hashlib.sha256(raw).hexdigest())
            same.append(raw == (text or "").encode())
        return pa.record_batch(
            [*rows.columns[: len(keep)], pa.array(n, pa.int64()), pa.array(size, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string()), pa.array(same, pa.bool_())],
            [*keep, "n_tokens", "n_bytes", "ids_sha256", "decoded_sha256", "lossless"],
        )

    text = docs["text"].alias("text")
    return map_slices(docs, [*(docs[c] for c in keep), text], step, f"{fields}, n_tokens long, n_bytes long, ids_sha256 string, decoded_sha256 string, lossless boolean")
