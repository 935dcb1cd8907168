"""Container entries to a manifest, and the plan for putting replacements back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinframe.functions import keys, sniff


def named_entries(entries: DataFrame, kind: str = "hwpx", include_preview: bool = False, sample: int | None = None) -> DataFrame:
    """Entries (doc, name) that pass by name alone: no content needs to be read for it. A sample is the first n names of each document."""
    keep = ~keys.is_markup_or_font(F.col("name")) if kind == "hwpx" else keys.in_bin_folder(F.col("name"))
    if not include_preview:
        keep = keep & ~keys.looks_like_preview(F.col("name"))
    rows = entries.where(keep)
    if sample is None:
        return rows
    w = Window.partitionBy("doc").orderBy("name")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= sample).drop("_n")


def manifest(entries: DataFrame, prefix: str = "extracted_", min_bytes: int = 0, raw_least: int = 0, include_vector: bool = True) -> DataFrame:
    """doc, source, ord, out_path, ext, bytes, mime of recognised entries (doc, name, content) that are large enough, numbered by name in each document."""
    rows = entries.where((F.octet_length("content") >= max(16, min_bytes)) & (F.octet_length("content") >= raw_least))
    rows = rows.withColumns({"ext": sniff.image_ext(F.col("content"), include_vector), "mime": sniff.image_mime(F.col("content"), include_vector)}).where("ext IS NOT NULL")
    n = F.row_number().over(Window.partitionBy("doc").orderBy("name"))
    return rows.select("doc", F.col("name").alias("source"), n.alias("ord"), F.format_string("%s%04d.%s", F.lit(prefix), n, F.col("ext")).alias("out_path"), "ext", F.octet_length("content").alias("bytes"), "mime")


def scales(text: str | Column) -> Column:
    """Down-scales from a comma-separated list: numbers from 0.05 up to but not 1; none of them gives the usual five."""
    given = F.filter(F.transform(F.split(F.lit(text) if isinstance(text, str) else text, ","), lambda x: F.trim(x).try_cast("double")), lambda s: s.isNotNull() & (s >= 0.05) & (s < 1))
    return F.when(F.size(given) > 0, given).otherwise(F.array(*map(F.lit, (0.9, 0.8, 0.7, 0.6, 0.5))))


def trials(first_quality: int = 95, least: int = 10, step: int = 5, downscale: str = "0.9,0.8,0.7,0.6,0.5") -> Column:
    """The order in which encodings are tried: full size from the best quality down, then smaller sizes at the least quality."""
    qualities = F.transform(F.sequence(F.lit(first_quality), F.lit(least), F.lit(-step)), lambda q: F.struct(q.alias("quality"), F.lit(1.0).alias("scale")))
    smaller = F.transform(scales(downscale), lambda s: F.struct(F.lit(least).alias("quality"), s.alias("scale")))
    return F.concat(qualities, smaller)


def fitted(tried: DataFrame) -> DataFrame:
    """For each stream (stream, original_size, attempt, quality, scale, size) the first attempt that fits, and the padding that fills it up.

    status: replaced, or fail_adjust where nothing fits.
    """
    fits = F.col("size") <= F.col("original_size")
    first = F.min(F.when(fits, F.struct("attempt", "quality", "scale", "size")))
    got = tried.groupBy("stream", "original_size").agg(first.alias("best"))
    return got.select("stream", "original_size", F.col("best.quality").alias("quality"), F.col("best.scale").alias("scale"), (F.col("original_size") - F.col("best.size")).alias("padding"), F.when(F.col("best").isNull(), "fail_adjust").otherwise("replaced").alias("status"))


def patch_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count("*").alias("n"))
