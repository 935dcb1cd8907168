"""Pairs of images: each image is on disk once, and pairs on the ladder are not shuffled."""

import os

import numpy as np

from twinframe.kernels import geometry, pixels
from twinframe.operators import candidates as C
from twinframe.operators import pairing
from twinframe.plans import surrogates as S
from twinframe.sources import samples
from twinframe.storage import fresh_folder, opened_folder


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def pictures(spark, n=8):
    rng = np.random.default_rng(4)
    made = {str(i): samples.picture(rng.random(64).tolist()) for i in range(n)}
    return made, spark.createDataFrame([(k, bytearray(pixels.encode_png(v))) for k, v in made.items()], "rel string, content binary")


def test_images_travel_once_however_many_pairs(spark):
    made, rows = pictures(spark)
    every = pairing.described(rows.union(spark.createDataFrame([("odd", bytearray(b"no image"))], rows.schema)))
    names = [*made, "odd"]
    pairs = spark.createDataFrame([(a, b, 1 + k) for a in names for k, b in enumerate(names)], "ref string, ex string, cand_ord int")
    for other in (every, pairing.described(rows)):
        got = pairing.scored(pairs, every, other)
        assert "png" not in plan(got) and "descriptors" not in plan(got)  # pairs carry places, not images
        got = {(r.ref, r.ex): r for r in got.collect()}
        assert set(got) == {(a, b) for a in made for b in made}
        points, found = zip(*(geometry.keypoints(i) for i in made.values()), strict=True)
        for i, a in enumerate(made):
            assert got[a, a].inliers == got[a, a].matches > 3 and got[a, a].ssim > 0.99
            for j, b in enumerate(made):
                assert got[a, b].matches == len(geometry.ratio_matches(found[i].astype("<f4").astype(float), found[j].astype("<f4").astype(float), 0.75, True))


def test_placed_records_are_read_back(spark):
    _, rows = pictures(spark)
    every = pairing.described(rows)
    folder = fresh_folder(spark, "test-described")
    where = pairing.placed(every, folder).collect()
    want = {r.rel: (bytes(r.png), bytes(r.points), bytes(r.descriptors)) for r in every.collect()}
    images = pairing.Placed(folder, most=1)
    assert {r.rel: images.read(r.file, r.at, r.size) for r in where} == want
    images.close()
    path = opened_folder(folder)[1]
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) == sum(r.size for r in where)


def test_pairs_on_the_ladder_are_counted_where_they_are_made(spark, sf):
    near = C.near_pairs(*S.both(spark, sf), S.SETTINGS)
    assert "Window" not in plan(C.laddered(near, S.SETTINGS))
