"""The variant index and other keyed artifacts: pivots, partial selections, upserts, merges, integrity, leaf maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinframe.functions import keys

VARIANT_KEY = ["category", "src_relpath", "track", "channel"]
TRACKS = ["color_low", "color_high", "gray_low", "gray_high"]


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """new, and those rows of old whose key new does not have (null keys equal each other)."""
    own = new.select(*(F.col(k).alias(f"_{k}") for k in key)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return new.unionByName(old.join(own, same, "left_anti"), allowMissingColumns=True)


def merge_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """Variants: all of a source's old rows go where new has the source at all."""
    own = new.select(F.col("category").alias("_c"), F.col("src_relpath").alias("_s")).distinct()
    return new.unionByName(old.join(own, (F.col("category") == F.col("_c")) & (F.col("src_relpath") == F.col("_s")), "left_anti"))


def pivoted(index: DataFrame) -> DataFrame:
    """One row for each image with the paths of its four variants (null where missing)."""
    kind = F.concat_ws("_", "channel", "track")
    return index.withColumn("_kind", kind).groupBy("category", "src_relpath").pivot("_kind", TRACKS).agg(F.min("out_relpath"))


def chosen_variant(color_low: str, gray_low: str, color_high: str, gray_high: str, source: str, choice: str) -> F.Column:
    """The path to copy for a choice (source, pre_low_color, pre_low_gray, pre_high_color, pre_high_gray), with its fallbacks."""
    chains = {
        "source": (source,),
        "pre_low_color": (color_low, gray_low, source),
        "pre_low_gray": (gray_low, color_low, source),
        "pre_high_color": (color_high, color_low, gray_high, source),
        "pre_high_gray": (gray_high, gray_low, color_high, source),
    }
    return F.coalesce(*(F.col(c) for c in chains[choice]))


def integrity(pivot: DataFrame) -> DataFrame:
    """Per category: images, and how many lack their low gray or low colour variant."""
    return pivot.groupBy("category").agg(F.count("*").alias("total"), F.count_if(F.col("gray_low").isNull()).alias("missing_gray"), F.count_if(F.col("color_low").isNull()).alias("missing_color"))


def listed_references(lines: DataFrame, column: str = "value") -> DataFrame:
    """The keys of a list with one key a line: blank lines and lines that begin with # do not count."""
    text = F.trim(F.col(column))
    return lines.where((text != "") & ~F.startswith(text, F.lit("#"))).select(keys.normal_key(F.col(column)).alias("ref")).distinct()


def selected(rows: DataFrame, targets: DataFrame | None, only: DataFrame | None = None, key: str = "src_relpath", empty_means_all: bool = True) -> DataFrame:
    """Rows whose key is among the feedback targets, or (there being none) among the listed references, or (there being none) all rows."""
    for chosen in (targets, only):
        if chosen is not None and not (empty_means_all and chosen.isEmpty()):
            return rows.join(chosen.select(F.col("ref").alias("_ref")).distinct(), F.col(key) == F.col("_ref"), "left_semi")
    return rows


def pending(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows not in the index with their present content (category, src_relpath, content_hash)."""
    return rows.join(index.select("category", "src_relpath", "content_hash"), ["category", "src_relpath", "content_hash"], "left_anti")


def totals(index: DataFrame) -> DataFrame:
    source = F.struct("src_relpath")
    return index.agg(
        F.countDistinct(F.when(F.col("category") == "extracted", source)).alias("extracted_files"),
        F.countDistinct(F.when(F.col("category") == "reference", source)).alias("reference_files"),
        F.count("*").alias("variants_total"),
    )


def legacy_leaf_map(mapping: DataFrame) -> DataFrame:
    """leaf and reference_path from a map of key to value, either side of which names a BinData entry; the last one of a leaf wins.

    mapping: ord, key, value.
    """
    left, right = keys.bin_leaf(F.col("key")), keys.bin_leaf(F.col("value"))
    rows = mapping.select("ord", F.coalesce(left, right).alias("leaf"), F.when(left.isNotNull(), F.col("value")).otherwise(F.col("key")).alias("reference_path")).where("leaf IS NOT NULL")
    return rows.groupBy("leaf").agg(F.max_by("reference_path", "ord").alias("reference_path"))


def leaf_map(mapping: DataFrame, manifest: DataFrame, reference_files: DataFrame) -> DataFrame:
    """leaf and reference_path: mapped pairs (ord, ref, ex) by the manifest (out_path, source), existing references only, the first one of a leaf."""
    places = manifest.select(keys.base_name(F.col("out_path")).alias("ex"), keys.bin_leaf(F.col("source")).alias("leaf")).where("leaf IS NOT NULL")
    found = mapping.join(places, "ex").join(reference_files.select("ref", F.col("path").alias("reference_path")).distinct(), "ref")
    w = Window.partitionBy("leaf").orderBy("ord", "ref")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("leaf", "reference_path")


def replacements(mapping: DataFrame, manifest: DataFrame, references: DataFrame) -> DataFrame:
    """doc, stream, ref and png (the reference's bytes) for `patching.patched`, one for each stream: of several pairs the first by ord, then ref.

    mapping: ord, ref, ex; manifest: doc, source, out_path; references: ref, content. ex is an image's path below the folder of written files
    (a document's folder, then out_path), or its bare name where only one document has such a name. Pairs without a place or a reference file have no row.
    """
    source = F.regexp_replace("source", r"^(?i:HWPX?):", "")
    places = manifest.select("doc", keys.slashes(source).alias("stream"), "out_path", F.concat(F.sha2("doc", 256), F.lit("/"), "out_path").alias("rel")).where(keys.in_bin_folder(F.col("stream")))
    names = places.groupBy(keys.base_name(F.col("out_path")).alias("rel")).agg(F.count("*").alias("n"), F.min("doc").alias("doc"), F.min("stream").alias("stream")).where("n = 1")
    known = places.select("rel", "doc", "stream").unionByName(names.select("rel", "doc", "stream"))
    found = mapping.select("ord", "ref", F.col("ex").alias("rel")).join(known, "rel").join(references.select("ref"), "ref", "left_semi")
    first = found.groupBy("doc", "stream").agg(F.min_by("ref", F.struct("ord", "ref")).alias("ref"))
    return first.join(references.select("ref", F.col("content").alias("png")), "ref").select("doc", "stream", "ref", "png")


def unresolved(mapping: DataFrame, manifest: DataFrame) -> DataFrame:
    """Mapped pairs whose extracted image has no manifest entry."""
    return mapping.join(manifest.select(keys.base_name(F.col("out_path")).alias("ex")), "ex", "left_anti")


def streams_of(leaves: DataFrame, streams: DataFrame) -> DataFrame:
    """The first stream (by name) under BinData of each leaf: equal base names in any case, with or without an extension."""
    name = F.lower(F.regexp_replace(keys.base_name(F.col("stream")), r"\.[^.]*$", ""))
    w = Window.partitionBy("leaf").orderBy("stream")
    met = leaves.join(streams.where(keys.in_bin_folder(F.col("stream"))).select("stream", name.alias("_name")), F.lower("leaf") == F.col("_name"))
    return met.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_name")


def inspect_manifest(mapping: DataFrame, ref_paths: DataFrame, ex_paths: DataFrame) -> DataFrame:
    """idx (four digits, by reference), ref_rel, ex_rel and the paths to copy; pairs without a path are kept with a null."""
    found = mapping.join(ref_paths.select(F.col("rel").alias("ref"), F.col("path").alias("ref_path")), "ref", "left").join(ex_paths.select(F.col("rel").alias("ex"), F.col("path").alias("ex_path")), "ex", "left")
    n = F.row_number().over(Window.orderBy("ref"))  # a report for people: a few hundred rows
    return found.select(F.format_string("%04d", n).alias("idx"), F.col("ref").alias("ref_rel"), F.col("ex").alias("ex_rel"), "ref_path", "ex_path")
