"""ZIP (HWPX) and compound-file (HWP) containers: readers, an equal-length stream writer, and their table functions.

The compound-file layout is Microsoft's published one: a header, a sector allocation table, a directory of named entries in a tree, and a second, small allocation
table for streams under 4096 bytes.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OLE_MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")
END, FREE = 0xFFFFFFFE, 0xFFFFFFFF


def kind_of(content: bytes) -> str:
    """hwpx for a ZIP with an entry under Contents/ or any .xml entry; hwp for a compound file; else unknown."""
    if content[:4] == b"PK\x03\x04":
        try:
            names = zipfile.ZipFile(io.BytesIO(content)).namelist()
        except zipfile.BadZipFile:
            return "unknown"
        return "hwpx" if any(n.startswith("Contents/") or n.lower().endswith(".xml") for n in names) else "unknown"
    return "hwp" if content[:8] == OLE_MAGIC else "unknown"


def zip_entries(content: bytes) -> Iterator[tuple[str, bytes]]:
    """Names and contents of a ZIP's files, by name; unreadable ones are left out."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile:
        return
    for info in sorted(archive.infolist(), key=lambda i: i.filename):
        if not info.is_dir():
            try:
                yield info.filename, archive.read(info)
            except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError):
                continue


class CompoundFile:
    """Streams of a compound file by path. Damaged chains end where they repeat or leave the file."""

    def __init__(self, content: bytes):
        self.content = bytearray(content)
        if content[:8] != OLE_MAGIC or len(content) < 512:
            raise ValueError("not a compound file")
        shift, mini_shift = struct.unpack_from("<HH", content, 30)
        self.sector, self.mini = 1 << shift, 1 << mini_shift
        n_fat, first_dir, _, self.cutoff, first_mini, _, first_difat, _ = self._header(content)
        table = list(struct.unpack_from("<109I", content, 76))
        at, seen = first_difat, set()
        while at not in (END, FREE) and at not in seen:
            seen.add(at)
            part = self._words(at)
            table += part[:-1]
            at = part[-1]
        self.fat = [w for s in table[:n_fat] if s not in (END, FREE) for w in self._words(s)]
        raw = self._read(self._chain(first_dir, self.fat))
        self.entries = [raw[i : i + 128] for i in range(0, len(raw) - 127, 128)]
        mini = self._read(self._chain(first_mini, self.fat)) if first_mini not in (END, FREE) else b""
        self.mini_fat = list(struct.unpack(f"<{len(mini) // 4}I", mini[: len(mini) // 4 * 4]))
        self.root = self._chain(struct.unpack_from("<I", self.entries[0], 116)[0], self.fat) if self.entries else []
        self.paths = dict(self._walk(self._child(0), ()))

    @staticmethod
    def _header(content: bytes) -> tuple[int, ...]:
        n_fat, first_dir = struct.unpack_from("<II", content, 44)
        cutoff, first_mini, n_mini, first_difat, n_difat = struct.unpack_from("<IIIII", content, 56)
        return n_fat, first_dir, 0, cutoff, first_mini, n_mini, first_difat, n_difat

    def _place(self, sector: int) -> int:
        return (sector + 1) * self.sector

    def _words(self, sector: int) -> list[int]:
        part = bytes(self.content[self._place(sector) : self._place(sector) + self.sector])
        return list(struct.unpack(f"<{len(part) // 4}I", part[: len(part) // 4 * 4]))

    @staticmethod
    def _chain(at: int, table: list[int]) -> list[int]:
        out, seen = [], set()
        while at < len(table) and at not in seen:
            seen.add(at)
            out.append(at)
            at = table[at]
        return out

    def _read(self, chain: list[int]) -> bytes:
        return b"".join(bytes(self.content[self._place(s) : self._place(s) + self.sector]) for s in chain)

    def _child(self, i: int) -> int:
        return struct.unpack_from("<I", self.entries[i], 76)[0] if i < len(self.entries) else FREE

    def _walk(self, i: int, above: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], int]]:
        todo, seen = [(i, above)], set()
        while todo:
            i, above = todo.pop()
            if i >= len(self.entries) or i in seen:
                continue
            seen.add(i)
            entry = self.entries[i]
            size = min(64, struct.unpack_from("<H", entry, 64)[0])
            path = (*above, entry[: max(0, size - 2)].decode("utf-16-le", "replace"))
            left, right, child = struct.unpack_from("<III", entry, 68)
            if entry[66] == 2:
                yield path, i
            elif entry[66] == 1:
                todo.append((child, path))
            todo += [(left, above), (right, above)]

    def _pieces(self, path: tuple[str, ...]) -> tuple[int, list[tuple[int, int]]]:
        """A stream's size and its (place, length) pieces in the file."""
        entry = self.entries[self.paths[path]]
        start, size = struct.unpack_from("<IQ", entry, 116)
        size &= 0xFFFFFFFF if self.sector == 512 else (1 << 64) - 1
        if size < self.cutoff:
            per = self.sector // self.mini
            places = [(self._place(self.root[m // per]) + m % per * self.mini, self.mini) for m in self._chain(start, self.mini_fat) if m // per < len(self.root)]
        else:
            places = [(self._place(s), self.sector) for s in self._chain(start, self.fat)]
        return size, places

    def read(self, path: tuple[str, ...]) -> bytes:
        size, places = self._pieces(path)
        return b"".join(bytes(self.content[a : a + n]) for a, n in places)[:size]

    def overwrite(self, path: tuple[str, ...], data: bytes) -> None:
        """Writes a stream in place; its length stays."""
        size, places = self._pieces(path)
        if len(data) != size or sum(n for _, n in places) < size:
            raise ValueError("a stream is replaced by one of equal length only")
        at = 0
        for place, n in places:
            part = data[at : at + n]
            self.content[place : place + len(part)] = part
            at += n


def ole_entries(content: bytes) -> Iterator[tuple[str, bytes]]:
    """Paths (joined by /) and contents of a compound file's streams, by path."""
    try:
        file = CompoundFile(content)
    except (ValueError, struct.error, IndexError):
        return
    for path in sorted(file.paths):
        try:
            yield "/".join(path), file.read(path)
        except (struct.error, IndexError):
            continue


def inflated(data: bytes) -> tuple[bool, bytes]:
    """Whether data is a raw deflate or zlib stream, and what it holds (else itself)."""
    for bits in (-15, 15):
        try:
            out = zlib.decompressobj(bits)
            raw = out.decompress(data) + out.flush()
            if out.eof and raw:
                return True, raw
        except zlib.error:
            continue
    return False, data


def entries(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """doc, kind, name, content of every entry of documents (path, content). One row in, many out: nothing is shuffled."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kind = kind_of(content or b"")
                found = list({"hwpx": zip_entries, "hwp": ole_entries}.get(kind, lambda _: iter(()))(content or b""))
                yield pa.record_batch([pa.array([doc] * len(found), pa.string()), pa.array([kind] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())], ["doc", "kind", "name", "content"])

    return documents.select(F.col("path").alias("doc"), "content").mapInArrow(run, "doc string, kind string, name string, content binary")


def guarded_inflate(found: DataFrame) -> DataFrame:
    """Entries with deflated images opened: a content of a known type stays as it is, an inflated one counts only if its type is known."""
    from twinframe.functions.sniff import image_ext

    @F.pandas_udf("binary")
    def opened(data: pd.Series) -> pd.Series:
        return data.map(lambda x: inflated(bytes(x))[1] if x else x)

    bare = image_ext(F.col("content"))
    tried = found.withColumn("_raw", F.when(bare.isNull() & (F.col("kind") == "hwp"), opened("content")))
    return tried.withColumn("content", F.when(image_ext(F.col("_raw")).isNotNull(), F.col("_raw")).otherwise(F.col("content"))).drop("_raw")
