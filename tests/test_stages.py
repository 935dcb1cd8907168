"""The stages from containers to patched documents, and their artifacts."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinframe import cli
from twinframe.kernels import pixels
from twinframe.operators import export
from twinframe.sources import artifacts, samples

RNG = np.random.default_rng(9)


def scene(seed):
    rng = np.random.default_rng(seed)
    image = np.full((96, 120, 3), 90, np.uint8)
    for _ in range(60):
        y, x, s = rng.integers(0, 84), rng.integers(0, 108), rng.integers(4, 14)
        image[y : y + s, x : x + s] = rng.integers(0, 255, 3)
    return image


def test_stages_end_to_end(spark, tmp_path):
    docs, refs = tmp_path / "docs", tmp_path / "reference"
    docs.mkdir(), refs.mkdir()
    pictures = [pixels.encode_png(scene(k)) for k in range(3)]
    (docs / "one.hwp").write_bytes(samples.compound_document({f"BIN{k:04d}.png": p for k, p in enumerate(pictures)}))
    for k in range(3):
        (refs / f"r{k}.png").write_bytes(pixels.encode_png(np.roll(scene(k), (2, 3), (0, 1))))
    t = str(tmp_path)
    cli.main(["extract", str(docs), f"{t}/extracted"])
    written = spark.read.parquet(f"{t}/extracted/written")
    assert written.count() == 3
    files = next((tmp_path / "extracted/files").iterdir())
    for name, folder in (("reference", refs), ("extracted", files)):
        cli.main(["preprocess", str(folder), f"{t}/v_{name}", "--category", name, "--low-size", "160", "--trim", "none", "--colorspace", "none"])
    cli.main(["candidates", f"{t}/v_reference", f"{t}/v_extracted", "--out", f"{t}/candidates", "--hist-threshold", "0.9"])
    cli.main(["match", f"{t}/v_reference", f"{t}/v_extracted", "--candidates", f"{t}/candidates", "--out", f"{t}/match", "--mutual-check", "--verify-photometric"])
    done = {r.ref: r.ex for r in spark.read.parquet(f"{t}/match/assigned").collect()}
    assert done == {f"r{k}.png": f"extracted_{k + 1:04d}.png" for k in range(3)}
    (tmp_path / "labels.csv").write_text("reference,extracted\n" + "".join(f"{r},{e}\n" for r, e in done.items()))
    cli.main(["evaluate", f"{t}/match/pairs", f"{t}/match/assigned", f"{t}/v_reference", "--out", f"{t}/eval", "--labels-csv", f"{t}/labels.csv"])
    assert spark.read.json(f"{t}/eval/report").first().recall_l == 1.0
    feedback = json.loads(spark.read.text(f"{t}/eval/feedback").first().value)
    assert feedback["summary"]["assigned"] == 3
    (tmp_path / "feedback.json").write_text(json.dumps(feedback))
    assert artifacts.targets(spark, f"{t}/feedback.json").count() == 0
    assert artifacts.overrides(spark, f"{t}/feedback.json").first().radius_delta == 4
    assert feedback["actions"]["expand_candidates"]["per_ref"] == [] and feedback["actions"]["tighten_verification"]["top2_margin"] == 6.0
    feedback["actions"]["tighten_verification"] = {"refs": ["r0.png", {"ref": "low|r1.png", "min_inliers": 100000}], "top2_margin": 9.0, "ssim_th": 0.95}
    (tmp_path / "tight.json").write_text(json.dumps(feedback))
    tight = {r.ref: (r.top2_margin, r.ssim_th, r.min_inliers) for r in artifacts.tightened(spark, f"{t}/tight.json").collect()}
    assert tight == {"r0.png": (9.0, 0.95, None), "r1.png": (9.0, 0.95, 100000.0)}
    cli.main(["match", f"{t}/v_reference", f"{t}/v_extracted", "--candidates", f"{t}/candidates", "--out", f"{t}/again", "--mutual-check", "--verify-photometric", "--feedback-in", f"{t}/tight.json"])
    assert "A" not in {r.phase for r in spark.read.parquet(f"{t}/again/pairs").where("ref = 'r1.png'").collect()}
    small = pixels.encode_png(np.zeros((8, 8, 3), np.uint8))
    doc = spark.read.format("binaryFile").load(str(docs)).first().path
    spark.createDataFrame([(doc, "BinData/BIN0000.png", small), (doc, "BinData/none", small)], "doc string, stream string, png binary").write.parquet(f"{t}/todo")
    cli.main(["patch", str(docs), f"{t}/todo", "--out", f"{t}/patched"])
    got = {r.stream: r.status for r in spark.read.parquet(f"{t}/patched").collect()}
    assert got == {"BinData/BIN0000.png": "replaced", "BinData/none": "fail_read"}


def test_artifacts_are_read_as_written(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"version": 1, "basis": "reference", "candidates": {"low|a\\b": [{"extracted": "e", "phash_dist": 3, "hist_dist": 0.5}], "low|c": []}}))
    got = artifacts.candidates(spark, str(tmp_path / "c.json")).collect()
    assert [tuple(r) for r in got] == [("a/b", "e", 3, 0.5, 1)]
    (tmp_path / "bad.json").write_text(json.dumps({"version": 1, "basis": "extracted", "candidates": {"x": []}}))
    with pytest.raises(Exception, match="basis of references"):
        artifacts.candidates(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "s.csv").write_text("ref,ex,score,ssim\na\\b,e,n/a,0.5\n,,,\n")
    assert [(r.ref, r.score, r.ssim) for r in artifacts.scores(spark, str(tmp_path / "s.csv")).collect()] == [("a/b", 0.0, 0.5), ("", 0.0, 0.0)]
    (tmp_path / "refs.txt").write_text("# no\n\n low|x \nx\ny\n")
    assert sorted(r.ref for r in artifacts.listed(spark, str(tmp_path / "refs.txt")).collect()) == ["x", "y"]
    df = spark.createDataFrame([("a", 1 / 3, True)], "ref string, score double, ok boolean")
    export.csv(df, str(tmp_path / "out"), ("score",))
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "out")).first()) == ("a", "0.333333", "1")
    lines = export.candidate_lines(spark.createDataFrame([("a", "e", 1, 0.5, 2), ("a", "f", 1, 0.4, 1)], "ref string, ex string, phash_dist int, hist_dist double, cand_ord int"))
    assert [c["extracted"] for c in json.loads(lines.first().value)["candidates"]] == ["f", "e"]
    both = export.result_lines(df.select("ref", "score"), spark.createDataFrame([("z",)], "ref string"))
    assert {json.loads(r.value)["state"] for r in both.collect()} == {"assigned", "unassigned"}
    assert df.select(F.col("ok")).first().ok
