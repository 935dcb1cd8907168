"""Operators against literal loops and their edge rows."""

import random

import pytest
from pyspark.sql import functions as F

from twinframe.functions import keys, measures
from twinframe.operators import candidates as C
from twinframe.operators import evaluation as E
from twinframe.operators import extraction as X
from twinframe.operators import index as I
from twinframe.operators import matching as M

IMAGE = "rel string, phash long, hist array<double>, w int, h int, edge_density double"


def images(spark, n, seed, start=0):
    rng = random.Random(seed)
    base = [random.Random(b).getrandbits(63) for b in range(4)]
    rows = []
    for i in range(n):
        bits = base[i % 4]
        for _ in range(rng.randrange(6)):
            bits ^= 1 << rng.randrange(63)
        hist = [rng.random() for _ in range(8)]
        rows.append((f"{start + i:03d}", bits, [h / sum(hist) for h in hist], rng.choice([0, 100, 200]), 100, rng.random()))
    return rows


def literal(refs, others, s):
    out = {}
    for ref, bits, hist, w, h, edge in refs:
        near = []
        for ex, b2, hist2, w2, h2, edge2 in others:
            import math

            d = bin(bits ^ b2).count("1")
            if w > 0 and w2 > 0 and abs(math.log((w2 / h2) / (w / h))) > s.aspect:
                continue
            if abs(edge - edge2) > s.edge:
                continue
            near.append((d, ex, math.sqrt(max(0, 1 - sum(math.sqrt(a * b) for a, b in zip(hist, hist2))))))
        r, kept = s.radius, []
        while r <= s.max_radius:
            kept = [x for x in near if x[0] <= r]
            if len(kept) >= s.min_candidates:
                break
            r += s.step
        ranked = sorted((hd, d, ex) for d, ex, hd in kept)
        good = [x for x in ranked if x[0] <= s.hist]
        rest = [x for x in ranked if x[0] > s.hist]
        good += rest[: max(0, s.min_candidates - len(good))]
        out[ref] = [ex for _, _, ex in sorted(good)]
    return out


@pytest.mark.parametrize("top", [6, 20])
def test_candidates_equal_a_literal_loop(spark, top):
    s = C.Settings(radius=4, step=2, max_radius=top, hist=0.25, min_candidates=3, aspect=0.5, edge=0.5)
    left, right = images(spark, 30, 1), images(spark, 40, 2, 500)
    got = C.candidates(spark.createDataFrame(left, IMAGE), spark.createDataFrame(right, IMAGE), s).orderBy("ref", "cand_ord").collect()
    mine = {}
    for r in got:
        mine.setdefault(r.ref, []).append(r.ex)
    assert mine == {k: v for k, v in literal(left, right, s).items() if v}


def test_dealt_blocks_find_what_a_broadcast_finds(spark, monkeypatch):
    refs = spark.createDataFrame(images(spark, 20, 3), IMAGE).select(F.col("rel").alias("ref"), "phash")
    others = spark.createDataFrame(images(spark, 20, 4), IMAGE).select(F.col("rel").alias("ex"), F.col("phash").alias("ex_phash"))
    one = {tuple(r) for r in C.hamming_ball(refs, others, F.lit(12), 12).select("ref", "ex").collect()}
    monkeypatch.setattr(C, "within", lambda *a: False)
    assert one == {tuple(r) for r in C.hamming_ball(refs, others, F.lit(12), 12).select("ref", "ex").collect()} and one


def test_missing_features_and_empty_sides(spark):
    refs = spark.createDataFrame([("a", None, [1.0], 1, 1, 0.1), ("b", 3, None, 1, 1, 0.1)], IMAGE)
    none = spark.createDataFrame([], IMAGE)
    assert C.candidates(refs, none).count() == 0
    stats = C.count_stats(C.candidates(refs, none), refs).first()
    assert (stats.reference_total, stats.mean, stats.max) == (2, 0.0, 0)


def serial(rows):
    best = {}
    for ref, ex, score, rank in rows:
        best[ref] = max(best.get(ref, -1), score)
    taken, out = set(), {}
    for ref in sorted(best, key=lambda r: (-best[r], r)):
        for _, ex in sorted((rank, ex) for r, ex, _, rank in rows if r == ref):
            if ex not in taken:
                taken.add(ex)
                out[ref] = ex
                break
    return out


def test_greedy_assignment_is_serial_dictatorship(spark):
    rng = random.Random(5)
    rows = []
    for r in range(40):
        scores = sorted((rng.randrange(8) * 1.0 for _ in range(5)), reverse=True)
        rows += [(f"r{r:02d}", ex, s, k + 1) for k, (ex, s) in enumerate(zip(rng.sample([f"e{i:02d}" for i in range(25)], 5), scores))]
    df = spark.createDataFrame(rows, "ref string, ex string, score double, rank int").withColumn("acceptable", F.lit(True))
    for parts in (1, 5):
        got = {r.ref: r.ex for r in M.assign_greedy(df.repartition(parts)).collect()}
        assert got == serial(rows)
    assert len(set(got.values())) == len(got)


def test_no_acceptable_pair(spark):
    df = spark.createDataFrame([("r", "e", 1.0, None)], "ref string, ex string, score double, rank int").withColumn("acceptable", F.lit(False))
    assert M.assign_greedy(df).count() == 0


def test_upsert_is_idempotent_and_knows_null_keys(spark):
    old = spark.createDataFrame([("a", "x", 1), (None, "x", 2), ("b", "x", 3)], "k string, s string, v int")
    new = spark.createDataFrame([("a", "x", 9), (None, "x", 8)], "k string, s string, v int")
    once = I.upsert(old, new, ["k", "s"])
    assert sorted(r.v for r in once.collect()) == [3, 8, 9]
    assert sorted(r.v for r in I.upsert(once, new, ["k", "s"]).collect()) == [3, 8, 9]


def test_empty_targets_mean_all(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "src_relpath string")
    none = spark.createDataFrame([], "ref string")
    one = spark.createDataFrame([("b",)], "ref string")
    assert I.selected(rows, none).count() == 2
    assert I.selected(rows, none, one).count() == 1
    assert I.selected(rows, none, empty_means_all=False).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([(" low|a\\b.png ", "HWP:BinData\\BIN0001.OLE.png", "C:\\root\\a\\b.png")], "k string, s string, p string")
    got = df.select(keys.normal_key(F.col("k")), keys.bin_leaf(F.col("s")), keys.relative_to(F.col("p"), F.lit("C:/root")), keys.relative_to(F.col("p"), F.lit("D:/"))).first()
    assert tuple(got) == ("a/b.png", "BIN0001.OLE", "a/b.png", "b.png")


def test_wilson_and_labels(spark):
    w = spark.range(1).select(measures.wilson(F.lit(0), F.lit(0)).alias("z"), measures.wilson(F.lit(9), F.lit(10)).alias("n")).first()
    assert tuple(w.z) == (0.0, 0.0) and 0.59 < w.n.low < 0.6 and 0.98 < w.n.high < 0.99
    raw = spark.createDataFrame([("", "a\\b", None), ("r", "", "e")], "ref string, reference string, extracted string")
    assert sorted(map(tuple, E.labels(raw).collect()), key=str) == [("a/b", None), ("r", "e")]


def test_labels_without_ex_take_any_partner(spark):
    mapping = spark.createDataFrame([("a", "x"), ("b", "y")], "ref string, ex string")
    free = spark.createDataFrame([("a", None), ("c", None)], "ref string, ex string")
    assert {r.ref: r.correct for r in E.judged(mapping, free).collect()} == {"a": True, "c": False}
    mixed = spark.createDataFrame([("a", None), ("b", "y")], "ref string, ex string")
    assert {r.ref: r.correct for r in E.judged(mapping, mixed).collect()} == {"a": False, "b": True}
    assert {r.ref: r.correct for r in E.judged(mapping, mixed, per_reference=True).collect()} == {"a": True, "b": True}


def test_scales_and_trials(spark):
    got = spark.range(1).select(X.scales("x, 0.5,1.2,0.01").alias("a"), X.scales("").alias("b"), F.size(X.trials()).alias("n")).first()
    assert got.a == [0.5] and got.b == [0.9, 0.8, 0.7, 0.6, 0.5] and got.n == 23
