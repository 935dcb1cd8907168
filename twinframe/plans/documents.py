"""The driver's rows as containers and pictures, for the operators that work on bytes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinframe.kernels import pixels
from twinframe.plans import surrogates as S
from twinframe.sources import samples


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rel, odd, content (a PNG) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pixels.encode_png(samples.picture(v)) for v in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(made, pa.binary())], ["rel", "odd", "content"])

    return S.images(spark, sf_dir).select("rel", "odd", "v").mapInArrow(run, "rel string, odd long, content binary")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, content: a container for every third vector, in turn a ZIP, a compound file with a raw and a deflated picture, and one that is neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, made = [], []
            for rel, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                png, k = pixels.encode_png(samples.picture(v)), int(rel) % 3
                packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                packed = packer.compress(png) + packer.flush()
                names.append(f"{rel}.{('hwpx', 'hwp', 'bin')[k]}")
                made.append(samples.zip_document({"Contents/section0.xml": b"<x/>", "BinData/image1.png": png, "Preview/PrvImage.png": png}) if k == 0 else samples.compound_document({"BIN0001.png": png, "BIN0002.png": packed, "note.txt": b"plain text of a note"}) if k == 1 else png)
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(made, pa.binary())], ["path", "content"])

    return S.images(spark, sf_dir).select("rel", "v").mapInArrow(run, "path string, content binary")
