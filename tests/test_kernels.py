"""Pixel kernels against closed forms, containers against round trips."""

import zlib

import numpy as np
import pytest

from twinframe.kernels import geometry as G
from twinframe.kernels import pixels as P
from twinframe.sources import containers as K
from twinframe.sources import samples

RNG = np.random.default_rng(7)


def scene(h=96, w=120):
    image = np.full((h, w), 90, np.uint8)
    for _ in range(40):
        y, x, s = RNG.integers(0, h - 12), RNG.integers(0, w - 12), RNG.integers(4, 12)
        image[y : y + s, x : x + s] = RNG.integers(0, 255)
    return image


def test_png_round_trip():
    for image in (scene(), np.stack([scene(20, 30)] * 3, axis=2), np.zeros((1, 1), np.uint8)):
        assert (P.decode_png(P.encode_png(image)) == image).all()
    assert P.decode_png(b"") is None and P.decode_png(P.PNG_MAGIC + b"broken") is None


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    line, above = RNG.integers(0, 255, 12).astype(np.uint8), RNG.integers(0, 255, 12).astype(np.uint8)
    left = np.concatenate([np.zeros(3, int), line[:-3].astype(int)])
    corner = np.concatenate([np.zeros(3, int), above[:-3].astype(int)])
    p = left + above - corner
    paeth = np.array([min((abs(q - a), 0, a), (abs(q - b), 1, b), (abs(q - c), 2, c))[2] for q, a, b, c in zip(p, left, above.astype(int), corner)])
    guess = [np.zeros(12, int), left, above.astype(int), (left + above) // 2, paeth][kind]
    assert (P._unfiltered(kind, ((line.astype(int) - guess) & 255).astype(np.uint8), above, 3) == line).all()


def test_hash_ignores_brightness_and_histogram_sums_to_one():
    image = (scene() // 2).astype(np.uint8)
    a, b = P.hash_block(image), P.hash_block(image + 40)
    assert np.allclose(a, b, atol=1e-6)
    assert abs(P.hsv_histogram(np.stack([image] * 3, axis=2)).sum() - 1) < 1e-9
    red = np.zeros((4, 4, 3), np.uint8)
    red[:, :, 2] = 255
    assert P.hsv_histogram(red).argmax() == 0 * 64 + 7 * 8 + 7


def test_letterbox_and_trim():
    image = np.stack([scene(50, 100)] * 3, axis=2)
    box, scale, pad = P.letterbox(image, 64)
    assert box.shape == (32, 64, 3) and scale == 0.64 and pad == (0, 0, 0, 0)
    bordered = np.full((120, 140), 255, np.uint8)
    bordered[30:90, 20:120] = 0
    cut, removed = P.auto_trim(bordered)
    assert abs(cut.shape[0] - 62) <= 4 and abs(removed[0] - 29) <= 2
    flat = np.full((30, 30), 9, np.uint8)
    assert P.auto_trim(flat)[1] == (0, 0, 0, 0)


def test_edges_of_a_step():
    step = np.zeros((40, 40), np.uint8)
    step[:, 20:] = 255
    found = P.edges(step)
    assert found.any(axis=0).sum() <= 2 and found[:, 18:22].any()
    assert P.edge_density(np.zeros((10, 10), np.uint8)) == 0


def test_clahe_keeps_flat_and_spreads_dull():
    dull = (scene() // 8 + 100).astype(np.uint8)
    assert P.clahe(dull).std() > dull.std()
    colours = P.lab_clahe(np.stack([dull, dull, dull], axis=2))
    assert np.ptp(colours.astype(int), axis=2).max() <= 2


def test_photometric_identities():
    x = scene()
    assert G.ssim(x, x) == pytest.approx(1) and G.gradient_ssim(x, x) == pytest.approx(1)
    assert G.ncc(x, x) == pytest.approx(1) and G.ncc(x, 255 - x) == pytest.approx(-1)
    assert G.ssim(x, x[:-1]) == 0 and G.ncc(x, x[:-1]) == 0


def test_homography_is_found_among_outliers_and_is_repeatable():
    h = np.array([[1.1, 0.05, 4], [-0.03, 0.95, -2], [1e-4, 0, 1]])
    src = RNG.uniform(0, 100, (40, 2))
    dst = G.project(h, src)
    dst[:12] = RNG.uniform(0, 100, (12, 2))
    got, good, rmse = G.homography(src, dst, 3, 1.0)
    assert np.allclose(got, h, atol=1e-6) and good.sum() >= 28 and rmse < 1e-6
    assert (G.homography(src, dst, 3, 1.0)[0] == got).all()
    assert G.homography(src[:3], dst[:3], 1)[0] is None


def test_a_shifted_picture_matches_itself_and_warps_back():
    x = scene(128, 128)
    y = np.roll(x, (6, 9), (0, 1))
    (p, d), (q, e) = G.keypoints(x), G.keypoints(y)
    m = G.ratio_matches(d, e, 0.8, True)
    h, good, _ = G.homography(p[m[:, 0]], q[m[:, 1]], 1, 2.0)
    assert good.sum() >= 8
    assert G.ncc(x[20:-20, 20:-20], G.warp_to_reference(x, y, h)[20:-20, 20:-20]) > 0.9


def test_ecc_pulls_a_small_shift_back():
    x = np.rint(P.filtered(scene(), P.gaussian(9, 2))).astype(np.uint8)
    y = np.roll(x, 1, 1)
    assert G.ncc(x[5:-5, 5:-5], G.ecc_align(x, y)[5:-5, 5:-5]) > G.ncc(x[5:-5, 5:-5], y[5:-5, 5:-5])
    flat = np.zeros((20, 20), np.uint8)
    assert (G.ecc_align(flat, flat) == flat).all()


def test_compound_round_trip_and_equal_length_patch():
    streams = {"BIN0001.png": b"a" * 100, "BIN0002.jpg": bytes(range(256)) * 40, "empty": b""}
    content = samples.compound_document(streams)
    assert K.kind_of(content) == "hwp"
    assert dict(K.ole_entries(content)) == {f"BinData/{k}": v for k, v in streams.items()}
    file = K.CompoundFile(content)
    file.overwrite(("BinData", "BIN0002.jpg"), b"z" * 10240)
    again = dict(K.ole_entries(bytes(file.content)))
    assert again["BinData/BIN0002.jpg"] == b"z" * 10240 and again["BinData/BIN0001.png"] == b"a" * 100
    assert len(file.content) == len(content)
    with pytest.raises(ValueError):
        file.overwrite(("BinData", "BIN0001.png"), b"short")


def test_damaged_containers_give_nothing():
    content = samples.compound_document({"a": b"x" * 5000})
    for cut in (0, 7, 8, 511, 600, len(content) // 2):
        list(K.ole_entries(content[:cut]))
    assert list(K.zip_entries(b"PK\x03\x04 broken")) == [] and K.kind_of(b"") == "unknown"
    assert K.kind_of(samples.zip_document({"a.bin": b"1"})) == "unknown"


def test_inflate():
    raw = b"some content " * 20
    packer = zlib.compressobj(9, zlib.DEFLATED, -15)
    assert K.inflated(packer.compress(raw) + packer.flush()) == (True, raw)
    assert K.inflated(zlib.compress(raw)) == (True, raw)
    assert K.inflated(raw) == (False, raw)


def test_streaming_ingest_upserts(spark, tmp_path):
    from twinframe.streaming.ingest import ingest

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.png").write_bytes(P.encode_png(scene()))
    run = lambda: ingest(spark, str(folder), str(tmp_path / "index"), str(tmp_path / "ck")).awaitTermination()
    run()
    (folder / "b.png").write_bytes(P.encode_png(scene()))
    (folder / "note.txt").write_text("no image")
    run()
    assert spark.read.parquet(str(tmp_path / "index/v=1")).count() == 2


def test_homographies_of_few_inliers_are_found():
    found = 0
    for seed in range(20):
        rng = np.random.default_rng(seed)
        src, dst = rng.uniform(0, 400, (100, 2)), rng.uniform(0, 400, (100, 2))
        dst[:20] = G.project(np.array([[1.1, 0.05, 5], [-0.04, 0.95, 9], [1e-4, -5e-5, 1]]), src[:20])
        found += int(G.homography(src, dst, seed, 2.0)[1][:20].sum()) == 20
    assert found >= 19


def test_detailed_images_keep_their_keypoints():
    image = np.random.default_rng(5).integers(0, 256, (300, 300), dtype=np.uint8)
    assert 400 < len(G.keypoints(image)[0]) <= 4000
