"""Image folders, and per-image work as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinframe.functions import keys, sniff
from twinframe.kernels import codecs, pixels

FEATURES = "rel string, w int, h int, block array<double>, hist array<double>, edge_density double"
VARIANTS = "rel string, track string, channel string, w int, h int, trimmed array<int>, scale double, pad array<int>, png binary"


def folder(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the image files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(keys.is_image_file(F.col("path"))).select("path", "content")


def unreadable(images: DataFrame) -> DataFrame:
    """rel, bytes and kind (by the leading bytes; null if unknown) of images (rel, content) that cannot be decoded: formats without a reader, and damaged files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                if codecs.decode(one.column(1)[0].as_py() or b"") is None:
                    yield one

    rows = images.select("rel", "content").mapInArrow(run, "rel string, content binary")
    return rows.select("rel", F.coalesce(F.octet_length("content"), F.lit(0)).alias("bytes"), sniff.image_ext(F.col("content")).alias("kind"))


def _each(images: DataFrame, fn, schema: str, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in batches:
            rows = []
            for rel, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                image = codecs.decode(content or b"")
                if image is not None:
                    rows += fn(rel, image)
            if rows:
                table = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows])
                kinds = kinds or _arrow(schema)
                yield from table.select(names).cast(kinds).to_batches()

    return images.select("rel", "content").mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def features(images: DataFrame) -> DataFrame:
    """Sizes, hash coefficients, histogram and edge density of images (rel, content); unreadable images have no row."""

    def one(rel: str, image: np.ndarray) -> list[tuple]:
        return [(rel, image.shape[1], image.shape[0], pixels.hash_block(image).tolist(), pixels.hsv_histogram(image).tolist(), pixels.edge_density(image))]

    return _each(images, one, FEATURES, [f.split()[0] for f in FEATURES.split(", ")])


def variants(images: DataFrame, low: int = 640, high: int | None = None, mode: str = "edge", multiple: int = 16, trim: bool = True, lab: bool = True, equalise_gray: bool = True) -> DataFrame:
    """Trimmed, equalised and letterboxed colour and gray variants of images (rel, content), as PNG."""
    tracks = [("low", low), *([("high", high)] if high else [])]

    def one(rel: str, image: np.ndarray) -> list[tuple]:
        cut, removed = pixels.auto_trim(image) if trim else (image, (0, 0, 0, 0))
        shaded = pixels.lab_clahe(cut) if lab else pixels.colour(cut)
        out = []
        for track, side in tracks:
            boxed, scale, pad = pixels.letterbox(shaded, side, multiple, mode)
            plain = pixels.gray(boxed)
            for channel, picture in (("color", boxed), ("gray", pixels.clahe(plain) if equalise_gray else plain)):
                out.append((rel, track, channel, picture.shape[1], picture.shape[0], list(removed), scale, list(pad), pixels.encode_png(picture)))
        return out

    return _each(images, one, VARIANTS, [f.split()[0] for f in VARIANTS.split(", ")])
