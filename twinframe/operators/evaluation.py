"""Evaluation against positive-only labels, suggestions, and the feedback that drives the next partial run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinframe.functions import keys, measures


def labels(rows: DataFrame) -> DataFrame:
    """ref and ex (nullable) from label rows with any of the accepted column names; rows without a reference go."""
    have = lambda names: [F.col(n) for n in names if n in rows.columns] or [F.lit(None).cast("string")]
    ref = keys.first_alias(*have(("ref", "reference", "ref_rel", "reference_rel")))
    ex = keys.first_alias(*have(("ex", "extracted", "ex_rel", "extracted_rel")))
    return rows.select(keys.slashes(ref).alias("ref"), keys.slashes(ex).alias("ex")).where("ref IS NOT NULL").distinct()


def judged(mapping: DataFrame, label_rows: DataFrame, per_reference: bool = False) -> DataFrame:
    """Each labelled reference with its mapped ex (null: none) and whether it is correct.

    A reference labelled without an ex is right with any partner only if no label has one (per_reference: if none of its own has).
    """
    wide = label_rows.groupBy("ref").agg(F.collect_set("ex").alias("accepted"))
    if per_reference:
        free = F.size("accepted") == 0
    else:
        wide = wide.join(F.broadcast(label_rows.agg(F.coalesce(F.bool_or(F.col("ex").isNotNull()), F.lit(False)).alias("_any"))))  # one row
        free = ~F.col("_any")
    joined = wide.join(mapping.select("ref", F.col("ex").alias("mapped")), "ref", "left")
    right = F.col("mapped").isNotNull() & (free | F.coalesce(F.array_contains("accepted", F.col("mapped")), F.lit(False)))
    return joined.select("ref", "mapped", right.alias("correct"))


def evaluation(mapping: DataFrame, unassigned: DataFrame, label_rows: DataFrame, suspects: DataFrame | None = None) -> DataFrame:
    """references, assigned, unassigned, labels_total, correct_on_labeled, recall_l (over labels), precision_lb (over assigned pairs; null without labels)."""
    every = mapping.select("ref").union(unassigned.select("ref")).distinct().agg(F.count("*").alias("references"))
    sizes = mapping.agg(F.count("*").alias("assigned")).join(F.broadcast(unassigned.agg(F.count("*").alias("unassigned"))))
    got = judged(mapping, label_rows).agg(F.count("*").alias("labels_total"), F.count_if("correct").alias("correct_on_labeled"))
    one = every.join(F.broadcast(sizes)).join(F.broadcast(got))  # a row each
    return one.withColumns({
        "recall_l": F.try_divide("correct_on_labeled", "labels_total"),
        "precision_lb": F.when(F.col("labels_total") > 0, F.try_divide("correct_on_labeled", "assigned")),
    })


def sample_precision(rows: DataFrame, outcome: Column) -> DataFrame:
    """n, correct, estimate and the Wilson interval (low, high) of checked samples."""
    got = rows.agg(F.count("*").alias("n"), F.count_if(outcome).alias("correct"))
    bounds = measures.wilson(F.col("correct"), F.col("n"))
    return got.select("n", "correct", F.coalesce(F.try_divide("correct", "n"), F.lit(0.0)).alias("estimate"), bounds["low"].alias("low"), bounds["high"].alias("high"))


def suggestions(scores: DataFrame, mapping: DataFrame, n: int = 20, only_unmatched: bool = False) -> DataFrame:
    """The n best pairs of each reference that are not its mapped one: scores' columns and rank, from 1."""
    own = mapping.select("ref", F.col("ex").alias("_ex"))
    rows = scores.join(own, "ref", "left_anti") if only_unmatched else scores.join(own, "ref", "left").where("_ex IS NULL OR ex <> _ex").drop("_ex")
    w = Window.partitionBy("ref").orderBy(F.col("score").desc(), F.col("inliers").desc(), "ex")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max(1, n))


# What an expanded reference takes in the next run.
RADIUS_DELTA, HIST, LEAST = 4.0, 0.80, 12.0


@dataclass(frozen=True)
class Thresholds:
    ssim: float = 0.90
    ncc: float = 0.85
    top2_margin: float = 6.0
    top2_multiplier: float = 1.40


def redo_refs(refs: DataFrame, scores: DataFrame) -> DataFrame:
    """References without any scored pair."""
    return refs.select(F.col("rel").alias("ref")).distinct().join(scores.select("ref"), "ref", "left_anti")


def expand_refs(scores: DataFrame, mapping: DataFrame) -> DataFrame:
    """Scored references without a partner."""
    return scores.select("ref").distinct().join(mapping.select("ref"), "ref", "left_anti")


def assigned_rows(scores: DataFrame, mapping: DataFrame) -> DataFrame:
    """The scored row of each mapped pair, preferring accepted phases, then the score."""
    w = Window.partitionBy("ref").orderBy(F.col("phase").isin("A", "B").desc(), F.col("score").desc(), "cand_ord")
    return scores.join(mapping.select("ref", "ex"), ["ref", "ex"], "left_semi").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def tighten_refs(scores: DataFrame, mapping: DataFrame, suspects: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Mapped references whose pair is borderline, and those reported as suspects."""
    weak = ((F.col("ssim") < t.ssim) & (F.col("ncc") < t.ncc)) | (F.col("top2_margin") < t.top2_margin) | (F.col("top2_multiplier") < t.top2_multiplier)
    return assigned_rows(scores, mapping).where(weak).select("ref").union(suspects.select("ref")).distinct()


def top_frequency(scores: DataFrame, k: int = 3) -> DataFrame:
    """In how many references' best k each extracted image stands: ex, refs."""
    w = Window.partitionBy("ref").orderBy(F.col("score").desc(), "cand_ord")
    return scores.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).groupBy("ex").agg(F.countDistinct("ref").alias("refs"))


def reuse_hint(scores: DataFrame, least: int = 3) -> DataFrame:
    return top_frequency(scores).agg(F.coalesce(F.bool_or(F.col("refs") >= least), F.lit(False)).alias("enabled"))


def feedback(refs: DataFrame, scores: DataFrame, mapping: DataFrame, suspects: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row for each reference and action: action (redo_preprocess, expand_candidates, tighten_verification), ref, and the values the next run takes."""
    none = F.lit(None).cast("double")
    redo = redo_refs(refs, scores).select(F.lit("redo_preprocess").alias("action"), "ref", none.alias("radius_delta"), none.alias("hist"), none.alias("min_candidates"), none.alias("top2_margin"), none.alias("top2_multiplier"), none.alias("ssim_th"), none.alias("ncc_th"))
    expand = expand_refs(scores, mapping).select(F.lit("expand_candidates").alias("action"), "ref", F.lit(RADIUS_DELTA).alias("radius_delta"), F.lit(HIST).alias("hist"), F.lit(LEAST).alias("min_candidates"), *(none.alias(n) for n in ("top2_margin", "top2_multiplier", "ssim_th", "ncc_th")))
    tight = tighten_refs(scores, mapping, suspects, t).select(F.lit("tighten_verification").alias("action"), "ref", *(none.alias(n) for n in ("radius_delta", "hist", "min_candidates")), F.lit(t.top2_margin).alias("top2_margin"), F.lit(t.top2_multiplier).alias("top2_multiplier"), F.lit(t.ssim).alias("ssim_th"), F.lit(t.ncc).alias("ncc_th"))
    return redo.unionByName(expand).unionByName(tight)


def feedback_document(actions: DataFrame, hint: DataFrame, summary: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """The feedback as one JSON document; an export of the actions, which stay the base. Values are the rows' own, or the defaults without rows; those of expanded references stand beside each of them too."""
    lists = actions.groupBy().pivot("action", ["redo_preprocess", "expand_candidates", "tighten_verification"]).agg(F.sort_array(F.collect_set("ref")))
    own = F.struct("ref", F.col("radius_delta").cast("int").alias("phash_radius_delta"), F.col("hist").alias("hist_threshold"), F.col("min_candidates").cast("int").alias("min_cand_per_basis"))
    values = actions.agg(
        F.coalesce(F.max("radius_delta"), F.lit(RADIUS_DELTA)).cast("int").alias("delta"), F.coalesce(F.max("hist"), F.lit(HIST)).alias("hist"), F.coalesce(F.max("min_candidates"), F.lit(LEAST)).cast("int").alias("least"),
        F.sort_array(F.collect_set(F.when(F.col("action") == "expand_candidates", own))).alias("per_ref"),
        *(F.coalesce(F.max(n), F.lit(v)).alias(n) for n, v in (("top2_margin", t.top2_margin), ("top2_multiplier", t.top2_multiplier), ("ssim_th", t.ssim), ("ncc_th", t.ncc))),
    )
    body = F.struct(
        F.lit("1").alias("version"), F.col("summary"),
        F.struct(
            F.struct(F.col("redo_preprocess").alias("refs"), F.array().cast("array<string>").alias("extracted_refs")).alias("redo_preprocess"),
            F.struct(F.col("expand_candidates").alias("refs"), F.col("delta").alias("phash_radius_delta"), F.col("hist").alias("hist_threshold_new"), F.col("least").alias("min_cand_per_basis"), "per_ref").alias("expand_candidates"),
            F.struct(F.col("tighten_verification").alias("refs"), "top2_margin", "top2_multiplier", "ssim_th", "ncc_th").alias("tighten_verification"),
            F.struct(F.col("enabled")).alias("allow_reuse"),
        ).alias("actions"),
    )
    one = summary.select(F.struct("*").alias("summary"))
    return lists.join(F.broadcast(values)).join(F.broadcast(hint)).join(F.broadcast(one)).select(F.to_json(body).alias("value"))  # a row each
