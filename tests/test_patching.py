"""From images of several formats to patched documents whose streams are read back."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_stages import scene
from twinframe import cli
from twinframe.kernels import codecs, pixels
from twinframe.operators import index, patching
from twinframe.sources import images, samples
from twinframe.sources.containers import CompoundFile, inflated


def deflate(raw):
    packer = zlib.compressobj(9, zlib.DEFLATED, -15)
    return packer.compress(raw) + packer.flush()


def test_first_fitting_encoding():
    old = scene(1)
    new = pixels.encode_png(np.roll(scene(2), 3, 0))
    for wrap in (lambda x: x, deflate, zlib.compress):
        original = wrap(codecs.encode_jpeg(old, 60))
        status, body, kind, wrapped, quality, scale = patching.fitted(new, original)
        assert (status, kind, scale) == ("replaced", "jpg", 1.0) and len(body) == len(original)
        assert wrapped == (original[:2] != b"\xff\xd8")
        assert codecs.decode(inflated(body)[1]).shape == old.shape
        sizes = {q: len(patching.deflated(codecs.encode_jpeg(pixels.colour(codecs.decode(new)), q), original)) for q in range(95, 9, -5)}
        assert quality == max(q for q, n in sizes.items() if n <= len(original))
    status, body, kind, _, quality, scale = patching.fitted(new, codecs.encode_jpeg(old, 2))
    assert status == "fail_adjust" or (quality, scale < 1) == (10, True)
    gray = codecs.encode_bmp(old[:, :, 0].copy())
    status, body, kind, *_ = patching.fitted(new, gray)
    assert (status, kind) == ("replaced", "bmp") and codecs.decode(body).ndim == 2
    assert patching.fitted(new, b"no picture")[0] == "fail_decompress" and patching.fitted(b"none", gray)[0] == "fail_image"
    tiny = pixels.encode_png(np.zeros((96, 120, 3), np.uint8), 9)
    assert patching.fitted(pixels.encode_png(np.random.default_rng(0).integers(0, 255, (96, 120, 3)).astype(np.uint8)), tiny)[:2] == ("fail_adjust", None)


def test_unreadable_images_are_rows(spark):
    rows = [("a", pixels.encode_png(scene(0))), ("b", b"\xff\xd8\xff"), ("c", None), ("d", b"RIFF\0\0\0\0WEBPVP8 "), ("e", codecs.encode_jpeg(scene(0), 80))]
    df = spark.createDataFrame(rows, "rel string, content binary")
    assert [tuple(r) for r in images.unreadable(df).orderBy("rel").collect()] == [("b", 3, "jpg"), ("c", 0, None), ("d", 16, "webp")]
    assert {r.rel for r in images.features(df).collect()} == {"a", "e"}


def test_replacements_keep_documents_apart(spark):
    manifest = spark.createDataFrame(
        [("d1", "HWP:BinData/B1.png", "extracted_0001.png"), ("d2", "BinData/B1.png", "extracted_0001.png"), ("d2", "BinData/B2.png", "extracted_0002.png"), ("d2", "Preview/P.png", "extracted_0003.png")],
        "doc string, source string, out_path string",
    )
    digest = {d: spark.range(1).select(F.sha2(F.lit(d), 256).alias("x")).first().x for d in ("d1", "d2")}
    pairs = [(2, "r2", f"{digest['d1']}/extracted_0001.png"), (1, "r1", f"{digest['d2']}/extracted_0001.png"), (3, "r3", "extracted_0001.png"), (4, "r4", "extracted_0002.png"), (5, "r5", "extracted_0002.png"), (0, "gone", "extracted_0002.png"), (6, "r1", "extracted_0003.png")]
    mapping = spark.createDataFrame(pairs, "ord int, ref string, ex string")
    refs = spark.createDataFrame([(f"r{k}", bytes([k])) for k in range(1, 6)], "ref string, content binary")
    got = sorted(map(tuple, index.replacements(mapping, manifest, refs).collect()))
    assert got == [("d1", "BinData/B1.png", "r2", b"\x02"), ("d2", "BinData/B1.png", "r1", b"\x01"), ("d2", "BinData/B2.png", "r4", b"\x04")]


@pytest.mark.parametrize("suffix", ["jpg", "bmp"])
def test_documents_are_patched_from_a_mapping(spark, tmp_path, suffix):
    docs, refs, t = tmp_path / "docs", tmp_path / "reference", str(tmp_path)
    docs.mkdir(), refs.mkdir()
    write = {"jpg": lambda x: codecs.encode_jpeg(x, 92), "bmp": codecs.encode_bmp}[suffix]
    streams = {"BIN0000.jpg": codecs.encode_jpeg(scene(0), 85), "BIN0001.jpg": deflate(codecs.encode_jpeg(scene(1), 85))}
    for name in ("one", "two"):
        (docs / f"{name}.hwp").write_bytes(samples.compound_document(streams))
        streams = {"BIN0007.png": pixels.encode_png(scene(2))}
    for k in range(3):
        (refs / f"r{k}.{suffix}").write_bytes(write(np.roll(scene(k), (2, 3), (0, 1))))
    cli.main(["extract", str(docs), f"{t}/x"])
    for name, folder in (("reference", refs), ("extracted", tmp_path / "x/files")):
        cli.main(["preprocess", str(folder), f"{t}/v_{name}", "--category", name, "--low-size", "160", "--trim", "none", "--colorspace", "none"])
        assert spark.read.parquet(f"{t}/v_{name}_unreadable").count() == 0
    cli.main(["candidates", f"{t}/v_reference", f"{t}/v_extracted", "--out", f"{t}/c", "--hist-threshold", "0.9"])
    cli.main(["match", f"{t}/v_reference", f"{t}/v_extracted", "--candidates", f"{t}/c", "--out", f"{t}/m", "--mutual-check"])
    assert spark.read.parquet(f"{t}/m/assigned").count() == 3
    cli.main(["patch", str(docs), "--mapping", f"{t}/m/assigned", "--manifest", f"{t}/x/manifest", "--references", str(refs), "--out", f"{t}/p", "--files", f"{t}/done"])
    report = spark.read.parquet(f"{t}/p").collect()
    assert {r.status for r in report} <= {"replaced", "fail_adjust"} and sum(r.status == "replaced" for r in report) >= 2
    written = {p.name: p for p in (tmp_path / "done").rglob("*.hwp")}
    assert set(written) == {"one.hwp", "two.hwp"}
    for r in report:
        name = r.doc.rsplit("/", 1)[1]
        before, after = (docs / name).read_bytes(), written[name].read_bytes()
        assert len(before) == len(after)
        old, new = (codecs.decode(inflated(CompoundFile(x).read(tuple(r.stream.split("/"))))[1]) for x in (before, after))
        assert old.shape == new.shape
        k = {"BIN0000.jpg": 0, "BIN0001.jpg": 1, "BIN0007.png": 2}[r.stream.rsplit("/", 1)[1]]
        want = np.roll(scene(k), (2, 3), (0, 1)) if r.status == "replaced" else scene(k)
        if r.scale in (0.0, 1.0):
            assert np.abs(new.astype(int) - want).mean() < 12
