"""Replacement of images inside compound files: encoding to a size, and in-place writing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinframe.kernels import codecs, pixels
from twinframe.sources.containers import CompoundFile, inflated


def deflated(raw: bytes, like: bytes) -> bytes:
    """raw, wrapped as `like` is: as a zlib stream, a raw deflate stream, or not at all."""
    try:
        zlib.decompress(like, 15)
        return zlib.compress(raw, 9)
    except zlib.error:
        pass
    if inflated(like)[0]:
        packer = zlib.compressobj(9, zlib.DEFLATED, -15)
        return packer.compress(raw) + packer.flush()
    return raw


@dataclass(frozen=True)
class Encoding:
    """The order of trials: JPEGs from the first quality down to the least, then smaller sizes at the least; other formats at smaller sizes only."""

    first_quality: int = 95
    least_quality: int = 10
    step: int = 5
    scales: tuple[float, ...] = (0.9, 0.8, 0.7, 0.6, 0.5)

    def trials(self, kind: str) -> list[tuple[int, float]]:
        qualities = range(self.first_quality, self.least_quality - 1, -self.step) if kind == "jpg" else (0,)
        return [(q, 1.0) for q in qualities] + [(self.least_quality if kind == "jpg" else 0, s) for s in self.scales]


WRITERS = {"jpg": codecs.encode_jpeg, "bmp": lambda image, _: codecs.encode_bmp(image), "png": lambda image, _: pixels.encode_png(image, 9)}


def fitted(image: bytes, original: bytes, e: Encoding = Encoding()) -> tuple[str, bytes | None, str, bool, int, float]:
    """status, body, format, whether it is deflated, quality (0 where the format has none) and scale of the first trial that fits the original stream.

    The picture takes the original's size, its channels (gray or colour, alpha dropped), its format (PNG for those that cannot be written)
    and its wrapping; zeros fill the body up. status: replaced, fail_adjust (nothing fits), fail_decompress (the original is no picture that can be
    read), fail_image (the replacement is none).
    """
    wrapped, raw = inflated(original)
    before, picture = codecs.decode(raw), codecs.decode(image or b"")
    kind = codecs.kind_of(raw)
    kind = kind if kind in WRITERS else "png"
    if before is None or picture is None:
        return "fail_decompress" if before is None else "fail_image", None, kind, wrapped, 0, 0.0
    picture = pixels.gray(picture) if before.ndim == 2 else pixels.colour(picture)
    if picture.shape[:2] != before.shape[:2]:
        picture = pixels.area_resize(picture, *before.shape[:2])
    for quality, scale in e.trials(kind):
        sides = (max(1, int(n * scale)) for n in picture.shape[:2])
        smaller = picture if scale == 1.0 else pixels.area_resize(picture, *sides)
        body = deflated(WRITERS[kind](np.ascontiguousarray(smaller), quality), original)
        if len(body) <= len(original):
            return "replaced", body + bytes(len(original) - len(body)), kind, wrapped, quality, scale
    return "fail_adjust", None, kind, wrapped, 0, 0.0


def patched(documents: DataFrame, replacements: DataFrame, encoding: Encoding = Encoding()) -> DataFrame:
    """doc, stream, status, format, is_deflate, quality, scale, original_size and, on each document's first row, content: the document with its streams replaced.

    documents: doc, content; replacements: doc, stream (path joined by /), png (an image of any kind that can be read). status: as in `fitted`, or fail_read
    (no such stream, or a document that is no compound file). A document is rewritten by one task; its length and all other bytes stay as they were.
    """
    schema = "doc string, stream string, status string, format string, is_deflate boolean, quality int, scale double, original_size long, content binary"
    wanted = replacements.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("stream", "png"))).alias("todo"))
    unread = (None, None, 0, 0.0, 0, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, content, todo in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                try:
                    file = CompoundFile(content)
                except Exception as damage:  # any damage is one outcome: the document stays as it is
                    out += [[doc, t["stream"], f"fail_read: {type(damage).__name__}", *unread] for t in todo]
                    continue
                for t in todo:
                    path = tuple(t["stream"].split("/"))
                    if path not in file.paths:
                        rows.append([doc, t["stream"], "fail_read", *unread])
                        continue
                    original = file.read(path)
                    status, body, *how = fitted(t["png"], original, encoding)
                    if body is not None:
                        file.overwrite(path, body)
                    rows.append([doc, t["stream"], status, *how, len(original), None])
                rows[0][-1] = bytes(file.content)
                out += rows
            kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.float64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], [f.split()[0] for f in schema.split(", ")])

    return documents.select("doc", "content").join(wanted, "doc").select("doc", "content", "todo").mapInArrow(run, schema)
