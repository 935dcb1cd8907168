"""Scored pairs to phases, separation, suspects, and one-to-one or one-to-many assignment.

Scores: ref, ex, cand_ord, detector, matches, inliers, inlier_ratio, score, ssim, ncc.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinframe.storage import discard, materialised


@dataclass(frozen=True)
class Rules:
    min_inliers: int = 12
    min_ratio: float = 0.22
    recall_sweep: bool = True
    min_inliers_b: int = 8
    min_ratio_b: float = 0.15
    photometric: bool = True
    ssim: float = 0.80
    ncc: float = 0.65
    top2_margin: float = 4.0
    top2_multiplier: float = 1.25


def best_detector(scores: DataFrame, detectors: tuple[str, ...] = ("SIFT", "ORB")) -> DataFrame:
    """The best row of each pair over detectors; of equal scores the first detector's."""
    rank = F.array_position(F.array(*map(F.lit, detectors)), F.col("detector"))
    w = Window.partitionBy("ref", "ex").orderBy(F.col("score").desc(), rank)
    return scores.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def classified(scores: DataFrame, r: Rules = Rules(), overrides: DataFrame | None = None, cap: int = 64) -> DataFrame:
    """scores with phase (A, B, ?), acceptable, rank, top2_margin, top2_multiplier and suspect.

    overrides: ref and, nullable, top2_margin, top2_multiplier, ssim_th, ncc_th, min_inliers, min_inlier_ratio. A reference's B pairs are acceptable only where it
    has no A pair. Only the first acceptable pair carries its distance to the second; suspects are flagged, never rejected.
    """
    names = {"top2_margin": r.top2_margin, "top2_multiplier": r.top2_multiplier, "ssim_th": r.ssim, "ncc_th": r.ncc, "min_inliers": r.min_inliers, "min_inlier_ratio": r.min_ratio}
    rows = scores.where(F.col("cand_ord") <= cap)
    if overrides is not None:
        rows = rows.join(overrides.groupBy("ref").agg(*(F.max(n).alias(f"_{n}") for n in names)), "ref", "left")
    else:
        rows = rows.withColumns({f"_{n}": F.lit(None) for n in names})
    local = {n: F.coalesce(F.col(f"_{n}"), F.lit(v)) for n, v in names.items()}
    photo = F.lit(True) if not r.photometric else (F.col("ssim") >= local["ssim_th"]) | (F.col("ncc") >= local["ncc_th"])
    easier = F.lit(True) if not r.photometric else (F.col("ssim") >= F.least(F.lit(0.9), local["ssim_th"])) | (F.col("ncc") >= F.least(F.lit(0.9), local["ncc_th"]))
    geometry = (F.col("inliers") >= local["min_inliers"]) & (F.col("inlier_ratio") >= local["min_inlier_ratio"])
    phase = F.when(geometry & photo, "A").when(F.lit(r.recall_sweep) & (F.col("inliers") >= r.min_inliers_b) & (F.col("inlier_ratio") >= r.min_ratio_b) & easier, "B").otherwise("?")
    rows = rows.withColumns({"passed_geom": geometry, "passed_photo": photo, "phase": phase, "_margin": local["top2_margin"], "_mult": local["top2_multiplier"]})
    has_a = F.max(F.col("phase") == "A").over(Window.partitionBy("ref"))
    rows = rows.withColumn("acceptable", F.when(has_a, F.col("phase") == "A").otherwise(F.col("phase") == "B"))
    w = Window.partitionBy("ref", "acceptable").orderBy(F.col("score").desc(), "cand_ord")
    rows = rows.withColumns({"_n": F.row_number().over(w), "_second": F.coalesce(F.lead("score").over(w), F.lit(0.0))})
    first = F.col("acceptable") & (F.col("_n") == 1)
    rows = rows.withColumns({
        "rank": F.when(F.col("acceptable"), F.col("_n")),
        "top2_margin": F.when(first, F.col("score") - F.col("_second")).otherwise(0.0),
        "top2_multiplier": F.when(first, F.col("score") / F.greatest(F.lit(1e-6), F.col("_second"))).otherwise(0.0),
    })
    suspect = first & ((F.col("top2_margin") < F.greatest(F.lit(0.0), F.col("_margin"))) | (F.col("top2_multiplier") < F.greatest(F.lit(1.0), F.col("_mult"))))
    return rows.withColumn("suspect", suspect).drop("_n", "_second", "_margin", "_mult", *(f"_{n}" for n in names))


def assign_reuse(pairs: DataFrame) -> DataFrame:
    """The best acceptable pair of each reference; an extracted image may serve several."""
    return pairs.where("acceptable AND rank = 1").drop("rank")


def assign_greedy(pairs: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """One-to-one: references in order of their best score (then name) take their best extracted image that is still free.

    By deferred acceptance: in each round every reference without a partner proposes to its best image that has not refused it, and every image keeps the first
    proposer in that order. All images share one order, so the single stable outcome is the serial one; rounds are bounded by the longest chain of refusals and
    each is a distributed step over open proposals.
    """
    own = pairs.where("acceptable").select("ref", "ex", "score", "rank")
    best = own.groupBy("ref").agg(F.max("score").alias("best"))
    own = materialised(own.join(best, "ref"), "proposals")
    turn = own.groupBy("ref").agg(F.lit(1).alias("at"), F.max("rank").alias("last"))
    moved = None
    for _ in range(max_rounds):
        asked = own.join(turn.where("at <= last").select("ref", F.col("at").alias("rank")), ["ref", "rank"]).select("ref", "ex", "best")
        # the minimum is combined before the shuffle, so an image that all references want gathers no rows
        first = asked.groupBy("ex").agg(F.min(F.struct((-F.col("best")).alias("best"), "ref"))["ref"].alias("_first"))
        refused = asked.join(first, "ex").where("ref <> _first").select("ref", F.lit(1).alias("_more"))
        last, moved = moved, materialised(turn.join(refused, "ref", "left").select("ref", (F.col("at") + F.coalesce("_more", F.lit(0))).alias("at"), "last", F.coalesce("_more", F.lit(0)).alias("moved")), "turns")
        if last is not None:
            discard(last)
        turn = moved.select("ref", "at", "last")
        if moved.where("moved = 1").isEmpty():
            break
    else:
        raise RuntimeError(f"the assignment is not settled after {max_rounds} rounds")
    won = turn.select("ref", F.col("at").alias("rank"))
    return pairs.where("acceptable").join(won, ["ref", "rank"]).drop("rank")


def unassigned(refs: DataFrame, assigned: DataFrame) -> DataFrame:
    return refs.select(F.col("rel").alias("ref")).distinct().join(assigned.select("ref"), "ref", "left_anti")


def assigned_suspects(pairs: DataFrame, assigned: DataFrame) -> DataFrame:
    return pairs.where("suspect").select("ref").distinct().join(assigned.select("ref"), "ref", "left_semi")


def match_stats(refs: DataFrame, assigned: DataFrame) -> DataFrame:
    """references, assigned, unassigned, phase_a, phase_b in one row."""
    every = refs.select(F.col("rel").alias("ref")).distinct().join(assigned.select("ref", "phase").withColumn("_in", F.lit(True)), "ref", "left")
    return every.agg(
        F.count("*").alias("references"), F.count("_in").alias("assigned"), (F.count("*") - F.count("_in")).alias("unassigned"),
        F.count_if(F.col("phase") == "A").alias("phase_a"), F.count_if(F.col("phase") == "B").alias("phase_b"),
    )
