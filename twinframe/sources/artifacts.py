"""JSON, CSV and list artifacts of the stages, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinframe.functions import keys, measures

# The artifacts' schemas.
CANDIDATES = "version int, basis string, track string, candidates map<string, array<struct<extracted: string, phash_dist: int, hist_dist: double>>>"
MAPPING = "version int, index array<struct<category: string, src_abspath: string, src_relpath: string, track: string, channel: string, out_abspath: string, out_relpath: string, orig_wh: array<int>, trimmed_pad: array<int>, scale: double, pad: array<int>>>"
MANIFEST = "source_file string, total_extracted int, items array<struct<source: string, order: int, out_path: string, ext: string, bytes: bigint, mime: string>>"
RESULT = "version int, assign_mode string, mapping map<string, string>, unassigned array<string>, suspects array<string>"
FEEDBACK = (
    "version string, actions struct<redo_preprocess: struct<refs: array<string>, extracted_refs: array<string>>, "
    "expand_candidates: struct<refs: array<string>, phash_radius_delta: int, hist_threshold_new: double, min_cand_per_basis: int, per_ref: array<struct<ref: string, phash_radius_delta: int, hist_threshold: double, min_cand_per_basis: int>>>, "
    "tighten_verification: struct<refs: array<string>, top2_margin: double, top2_multiplier: double, ssim_th: double, ncc_th: double>, allow_reuse: struct<enabled: boolean>>"
)
SCORE_NUMBERS = ("matches", "inliers", "inlier_ratio", "reproj_rmse", "score", "ssim", "ncc", "gssim", "top2_margin", "top2_multiplier")


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """ref, ex, phash_dist, hist_dist, cand_ord; an artifact on another basis is refused."""
    whole = document(spark, path, CANDIDATES)
    checked = whole.withColumn("candidates", F.when((F.col("basis") == "reference") & F.col("candidates").isNotNull(), F.col("candidates")).otherwise(F.raise_error(F.lit("candidates on the basis of references are asked for"))))
    rows = checked.select(F.explode("candidates").alias("key", "found")).select(keys.normal_key(F.col("key")).alias("ref"), F.posexplode("found").alias("pos", "c"))
    return rows.select("ref", F.col("c.extracted").alias("ex"), "c.phash_dist", "c.hist_dist", (F.col("pos") + 1).alias("cand_ord"))


def variants(spark: SparkSession, path: str) -> DataFrame:
    return document(spark, path, MAPPING).select(F.inline("index"))


def manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Items of manifests: one document a file or, as `extract` writes them, one a line."""
    whole = spark.read.schema(MANIFEST).json(path) if lines else document(spark, path, MANIFEST)
    return whole.select("source_file", F.explode("items").alias("i")).select("source_file", "i.*")


def mapping(spark: SparkSession, path: str) -> DataFrame:
    return document(spark, path, RESULT).select(F.explode("mapping").alias("ref", "ex"))


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """Candidate overrides of a feedback document: rel (null: for all references it names), radius_delta, hist, min_candidates."""
    e = document(spark, path, FEEDBACK).select("actions.expand_candidates.*")
    wide = e.select(F.lit(None).cast("string").alias("rel"), F.col("phash_radius_delta").alias("radius_delta"), F.col("hist_threshold_new").alias("hist"), F.col("min_cand_per_basis").alias("min_candidates"))
    named = e.select(F.explode("refs").alias("rel")).select(keys.normal_key(F.col("rel")).alias("rel"), F.lit(None).cast("int").alias("radius_delta"), F.lit(None).cast("double").alias("hist"), F.lit(None).cast("int").alias("min_candidates"))
    own = e.select(F.explode("per_ref").alias("p")).select(keys.normal_key(F.col("p.ref")).alias("rel"), F.col("p.phash_radius_delta").alias("radius_delta"), F.col("p.hist_threshold").alias("hist"), F.col("p.min_cand_per_basis").alias("min_candidates"))
    return wide.unionByName(named).unionByName(own)


def tightened(spark: SparkSession, path: str) -> DataFrame:
    """Overrides for matching from a feedback document: ref and, nullable, top2_margin, top2_multiplier, ssim_th, ncc_th, min_inliers, min_inlier_ratio.

    A reference is named by its key, or by an object with values of its own, which go before the document's.
    """
    t = document(spark, path, FEEDBACK).select("actions.tighten_verification.*")
    shared = ("top2_margin", "top2_multiplier", "ssim_th", "ncc_th")
    own = lambda n: F.get_json_object("r", f"$.{n}")
    rows = t.select(F.explode("refs").alias("r"), *shared).withColumn("_own", F.col("r").startswith("{"))
    values = [F.coalesce(F.when(F.col("_own"), own(n)).cast("double"), F.col(n) if n in shared else F.lit(None)).alias(n) for n in (*shared, "min_inliers", "min_inlier_ratio")]
    return rows.select(keys.normal_key(F.when(F.col("_own"), own("ref")).otherwise(F.col("r"))).alias("ref"), *values).where("ref IS NOT NULL")


def targets(spark: SparkSession, path: str) -> DataFrame:
    """ref of every reference that a feedback document wants redone or expanded."""
    a = document(spark, path, FEEDBACK).select("actions.*")
    both = F.concat(F.coalesce("redo_preprocess.refs", F.array()), F.coalesce("expand_candidates.refs", F.array()))
    return a.select(F.explode(both).alias("ref")).select(keys.normal_key(F.col("ref")).alias("ref")).distinct()


def rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all strings, missing values as empty ones."""
    return spark.read.option("header", True).csv(path).na.fill("")


def scores(spark: SparkSession, path: str) -> DataFrame:
    """Pair scores from their CSV: numbers that are none become 0."""
    df = rows(spark, path)
    return df.withColumns({c: measures.number_or(F.col(c)) for c in SCORE_NUMBERS if c in df.columns} | {c: keys.slashes(F.col(c)) for c in ("ref", "ex")})


def listed(spark: SparkSession, path: str) -> DataFrame:
    from twinframe.operators.index import listed_references

    return listed_references(spark.read.text(path))
