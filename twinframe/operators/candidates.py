"""Candidate pairs: a Hamming-ball join with prefilters, a radius ladder, a histogram threshold, and a top-up.

Inputs, one row for each image: rel, phash (long), hist (array<double>), w, h, edge_density. References keep their rows even when nothing is near them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinframe.functions import measures
from twinframe.storage import BROADCAST_BYTES, materialised, within


@dataclass(frozen=True)
class Settings:
    radius: int = 28
    step: int = 2
    max_radius: int = 36
    hist: float = 0.70
    min_candidates: int = 5
    aspect: float = 0.50
    edge: float = 0.30
    full_ladder: bool = True
    """Whether the ladder climbs to max_radius for every reference, or only as far as an override raises its own radius."""
    cap: int = 64


#: Radius up to which banding prunes: r + 1 bands of about 63 / (r + 1) bits.
BANDED = 6
#: Bytes of one extracted row in a broadcast: rel, hash and sizes, without its histogram; and of a number in a histogram.
ROW_BYTES, NUMBER_BYTES = 128, 8


def hamming_ball(refs: DataFrame, others: DataFrame, radius: Column, most: int) -> DataFrame:
    """All pairs with hamming(refs.phash, others.ex_phash) <= radius (a column of refs, `most` at most), with phash_dist.

    Up to BANDED bits the pairs meet in an equal band (of most + 1 bands at least one is equal). Beyond that nearly every band is shared, so all of the smaller
    side's hashes are compared: broadcast where its measured size allows, else dealt in blocks, each reference going to every block.
    """
    dist = measures.hamming(F.col("phash"), F.col("ex_phash"))
    if most <= BANDED:
        bands = most + 1
        cut = [round(i * measures.HASH_BITS / bands) for i in range(bands + 1)]

        def banded(df: DataFrame, column: str, name: str) -> DataFrame:
            keys = [F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(column, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]
            return df.withColumn(name, F.explode(F.array(*keys)))

        equal = [F.shiftrightunsigned(F.col("phash").bitwiseXOR(F.col("ex_phash")), a).bitwiseAND(F.lit((1 << (b - a)) - 1)) == 0 for a, b in zip(cut[:-1], cut[1:], strict=True)]
        first = F.coalesce(*(F.when(e, F.lit(i)) for i, e in enumerate(equal)))
        met = banded(refs, "phash", "_band").join(banded(others, "ex_phash", "_ex_band"), F.col("_band") == F.col("_ex_band"))
        met = met.where(first == F.col("_band.band")).drop("_band", "_ex_band")
    elif within(others, ROW_BYTES):
        met = refs.join(F.broadcast(others), dist <= radius)
    else:
        blocks = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = refs.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        met = dealt.join(others.withColumn("_ex_block", F.pmod(F.xxhash64("ex"), F.lit(blocks)).cast("int")), F.col("_block") == F.col("_ex_block")).drop("_block", "_ex_block")
    return met.withColumn("phash_dist", dist).where(F.col("phash_dist") <= radius)


def with_overrides(refs: DataFrame, s: Settings, overrides: DataFrame | None) -> DataFrame:
    """refs with loc_radius, loc_hist and loc_min: per-reference override, else the global one (rel null), else the settings.

    overrides: rel, radius_delta, hist, min_candidates (all but rel nullable). A delta raises the radius up to max_radius.
    """
    if overrides is None:
        return refs.withColumns({"loc_radius": F.lit(s.radius), "loc_hist": F.lit(s.hist), "loc_min": F.lit(s.min_candidates), "overridden": F.lit(False)})
    own = overrides.where("rel IS NOT NULL").groupBy("rel").agg(F.max("radius_delta").alias("_d"), F.max("hist").alias("_h"), F.max("min_candidates").alias("_m"), F.lit(True).alias("_own"))
    wide = overrides.where("rel IS NULL").agg(F.max("radius_delta").alias("_gd"), F.max("hist").alias("_gh"), F.max("min_candidates").alias("_gm"))
    joined = refs.join(own, "rel", "left").join(F.broadcast(wide))  # one row
    hit = F.coalesce(F.col("_own"), F.lit(False))
    pick = lambda name, default: F.when(hit, F.coalesce(F.col(f"_{name}"), F.col(f"_g{name}"), F.lit(default))).otherwise(F.lit(default))
    radius = F.least(F.lit(s.max_radius), F.lit(s.radius) + pick("d", 0))
    return joined.withColumns({"loc_radius": radius, "loc_hist": pick("h", s.hist), "loc_min": pick("m", s.min_candidates), "overridden": hit}).drop("_d", "_h", "_m", "_own", "_gd", "_gh", "_gm")


def near_pairs(refs: DataFrame, extracted: DataFrame, s: Settings = Settings(), overrides: DataFrame | None = None) -> DataFrame:
    """Pairs within each reference's last radius, with aspect_ok and edge_ok (a missing side passes; a negative bound turns the test off)."""
    base = with_overrides(refs.where("phash IS NOT NULL AND hist IS NOT NULL"), s, overrides)
    top = F.greatest(F.col("loc_radius"), F.lit(s.max_radius)) if s.full_ladder else F.col("loc_radius")
    base = base.withColumn("top_radius", top).select(F.col("rel").alias("ref"), "phash", "w", "h", "edge_density", "loc_radius", "loc_hist", "loc_min", "top_radius")
    others = extracted.where("phash IS NOT NULL").select(F.col("rel").alias("ex"), F.col("phash").alias("ex_phash"), F.col("w").alias("ex_w"), F.col("h").alias("ex_h"), F.col("edge_density").alias("ex_edge"))
    met = hamming_ball(base, others, F.col("top_radius"), max(s.radius, s.max_radius))
    gap = measures.log_aspect_gap(F.col("ex_w"), F.col("ex_h"), F.col("w"), F.col("h"))
    aspect_ok = F.lit(s.aspect < 0) | gap.isNull() | (gap <= s.aspect)
    edge = F.abs(F.col("ex_edge") - F.col("edge_density"))
    edge_ok = F.lit(s.edge < 0) | edge.isNull() | (edge <= s.edge)
    return met.select("ref", "ex", "phash_dist", "loc_radius", "loc_hist", "loc_min", "top_radius", aspect_ok.alias("aspect_ok"), edge_ok.alias("edge_ok"))


def laddered(pairs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The survivors of the prefilters on the first rung (radius, radius + step, ...) that holds loc_min of them, else on the last rung."""
    first = F.least(F.lit(s.radius), F.col("loc_radius"))
    rung = first + F.greatest(F.lit(0), F.ceil((F.col("phash_dist") - first) / s.step)).cast("int") * s.step
    last = first + F.floor((F.col("top_radius") - first) / s.step).cast("int") * s.step
    kept = pairs.where("aspect_ok AND edge_ok").withColumns({"rung": rung, "last": last}).where("rung <= last")
    # pairs on the ladder grow with the square of the images, so they are counted by rung where they are made, and made again as far as the chosen rung:
    # neither a shuffle nor a disk ever holds them all
    counts = kept.groupBy("ref", "rung").agg(F.count("*").alias("n"), F.max("loc_min").alias("least"), F.max("last").alias("last"))
    counts = counts.withColumn("held", F.sum("n").over(Window.partitionBy("ref").orderBy("rung")))
    stop = counts.groupBy("ref").agg(F.coalesce(F.min(F.when(F.col("held") >= F.col("least"), F.col("rung"))), F.max("last")).alias("chosen"))
    stop = materialised(stop, "stops")
    stop = F.broadcast(stop) if within(stop, ROW_BYTES) else stop
    return kept.join(stop, "ref").where("rung <= chosen").select("ref", "ex", "phash_dist", "loc_hist", "loc_min", "chosen")


def ranked(pairs: DataFrame, refs: DataFrame, extracted: DataFrame) -> DataFrame:
    """Histogram distances of the pairs, the threshold with its top-up, and the order: ref, ex, phash_dist, hist_dist, passed, cand_ord.

    Histograms join only here, for pairs that are left; the extracted ones by broadcast where their measured size allows, so that no pair is shuffled with one. Fewer than loc_min passing pairs are filled up with the best of the others.
    """
    ref_hist = refs.select(F.col("rel").alias("ref"), F.col("hist").alias("_p"))
    ex_hist = extracted.where("hist IS NOT NULL").select(F.col("rel").alias("ex"), F.col("hist").alias("_q"))
    wide = ex_hist.agg(F.coalesce(F.sum(F.size("_q") * NUMBER_BYTES + ROW_BYTES), F.lit(0))).first()[0]
    measured = pairs.join(ref_hist, "ref").join(F.broadcast(ex_hist) if wide <= BROADCAST_BYTES else ex_hist, "ex").withColumn("hist_dist", measures.hellinger(F.col("_p"), F.col("_q"))).drop("_p", "_q")
    measured = measured.withColumn("passed", F.col("hist_dist") <= F.col("loc_hist"))
    order = ["hist_dist", "phash_dist", "ex"]
    fill = F.row_number().over(Window.partitionBy("ref").orderBy(F.col("passed").desc(), *order))
    kept = measured.withColumn("_fill", fill).where(F.col("passed") | (F.col("_fill") <= F.col("loc_min")))
    return kept.select("ref", "ex", "phash_dist", "hist_dist", "passed", F.row_number().over(Window.partitionBy("ref").orderBy(*order)).alias("cand_ord"))


def candidates(refs: DataFrame, extracted: DataFrame, s: Settings = Settings(), overrides: DataFrame | None = None) -> DataFrame:
    return ranked(laddered(near_pairs(refs, extracted, s, overrides), s), refs, extracted)


def count_stats(found: DataFrame, refs: DataFrame) -> DataFrame:
    """Candidates for each reference: mean, median, min, max, p10, p90 (linear interpolation); references without any count as 0."""
    counts = refs.select(F.col("rel").alias("ref")).join(found.groupBy("ref").agg(F.count("*").alias("n")), "ref", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return counts.agg(
        F.count("*").alias("reference_total"),
        zero(F.avg("n")).alias("mean"), zero(F.median("n")).alias("median"),
        F.coalesce(F.min("n"), F.lit(0)).alias("min"), F.coalesce(F.max("n"), F.lit(0)).alias("max"),
        zero(F.percentile("n", 0.1)).alias("p10"), zero(F.percentile("n", 0.9)).alias("p90"),
    )


def prefilter_stats(pairs: DataFrame) -> DataFrame:
    """Distinct pairs that each prefilter takes; the edge test sees what the aspect test left."""
    return pairs.agg(F.count_if(~F.col("aspect_ok")).alias("removed_aspect"), F.count_if(F.col("aspect_ok") & ~F.col("edge_ok")).alias("removed_edge"))
