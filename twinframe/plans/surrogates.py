"""The driver's tables read as the engine's relations, so that SQL can judge the relational operators.

embeddings: even ids are references, odd ids extracted images; the 64 numbers stand for a block of coefficients (the first is dropped for the hash), a
histogram and, pairwise, descriptors. documents, pages, events, benchmark, labels and conversations stand for blobs, entry names, checked samples, lists and labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinframe.functions import measures
from twinframe.operators.candidates import Settings, candidates
from twinframe.operators.matching import Rules, assign_greedy, best_detector, classified
from twinframe.storage import materialised

SETTINGS = Settings(radius=20, step=2, max_radius=28, hist=0.37, min_candidates=4, aspect=0.5, edge=0.30)
RULES = Rules(min_inliers=12, min_ratio=0.30, min_inliers_b=8, min_ratio_b=0.20, ssim=0.30, ncc=0.30, top2_margin=1.0, top2_multiplier=1.05)
EDGE_STEP = 0.1
TOLERANCE = {"SIFT": 0.06, "ORB": 0.05}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rel, odd, v, phash, hist, w, h, edge_density."""
    rows = table(spark, sf_dir, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = rows.select(F.col("vec_id").cast("string").alias("rel"), (F.col("vec_id") % 2).alias("odd"), v.alias("v"), "vec_id", "label")
    steps = F.zip_with(F.slice("v", 1, 63), F.slice("v", 2, 63), lambda a, b: F.when(F.abs(a - b) > EDGE_STEP, 1.0).otherwise(0.0))
    return rows.select(
        "rel", "odd", "v", "label",
        measures.pack_hash(F.slice("v", 2, 63)).alias("phash"),
        measures.shares(F.col("v")).alias("hist"),
        (100 + (37 * F.col("vec_id")) % 400).alias("w"), (100 + (53 * F.col("vec_id")) % 300).alias("h"),
        (measures.total(steps) / 63).alias("edge_density"),
    )


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = images(spark, sf_dir)
    return every.where("odd = 0"), every.where("odd = 1")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, extracted = both(spark, sf_dir)
    return candidates(refs, extracted, SETTINGS)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored row for each candidate and detector: signs that agree are matches, small differences inliers."""
    refs, extracted = both(spark, sf_dir)
    pairs = found(spark, sf_dir).join(refs.select(F.col("rel").alias("ref"), F.col("v").alias("x")), "ref").join(extracted.select(F.col("rel").alias("ex"), F.col("v").alias("y")), "ex")
    zipped = F.arrays_zip(F.col("x").alias("a"), F.col("y").alias("b"))
    agree = F.filter(zipped, lambda p: F.signum(p["a"]) == F.signum(p["b"]))

    def inliers(tolerance: float) -> Column:
        return F.size(F.filter(agree, lambda p: F.abs(p["a"] - p["b"]) <= tolerance))

    kinds = F.array(*(F.struct(F.lit(d).alias("detector"), F.size(agree).alias("matches"), inliers(t).alias("inliers")) for d, t in TOLERANCE.items()))
    rows = pairs.select("ref", "ex", "cand_ord", measures.structural_similarity(F.col("x"), F.col("y")).alias("ssim"), measures.correlation(F.col("x"), F.col("y")).alias("ncc"), F.explode(kinds).alias("k"))
    rows = rows.select("ref", "ex", "cand_ord", "k.detector", "k.matches", "k.inliers", "ssim", "ncc")
    return rows.withColumns({"inlier_ratio": measures.inlier_ratio(F.col("inliers"), F.col("matches")), "score": measures.pair_score(F.col("inliers"), F.col("matches"))})


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(best_detector(scores(spark, sf_dir)), RULES)


def matched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The classified pairs, scored once, and their one-to-one assignment."""
    scored = materialised(pairs(spark, sf_dir), "pairs")
    return scored, assign_greedy(scored)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir)[1]
