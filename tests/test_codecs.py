"""Decoders and encoders of image files against the JVM's own, and their outcome for damaged files."""

import struct
import zlib

import numpy as np
import pytest

from twinframe.kernels import codecs
from twinframe.kernels import pixels as P

RNG = np.random.default_rng(11)


def smooth(h=61, w=83):
    y, x = np.mgrid[:h, :w]
    return np.stack([128 + 100 * np.sin(x / 17), 128 + 90 * np.cos(y / 13), 128 + 80 * np.sin((x + y) / 23)], axis=2).astype(np.uint8)


def rewritten(spark, data, kind, progressive=False, interlaced=False):
    """data, read and written by the JVM in another format."""
    io = spark._jvm.javax.imageio.ImageIO
    image = io.read(spark._jvm.java.io.ByteArrayInputStream(data))
    if image is None:
        return None
    out = spark._jvm.java.io.ByteArrayOutputStream()
    writer = io.getImageWritersByFormatName(kind).next()
    param = writer.getDefaultWriteParam()
    if progressive or interlaced:
        param.setProgressiveMode(1)
    stream = io.createImageOutputStream(out)
    writer.setOutput(stream)
    writer.write(None, spark._jvm.javax.imageio.IIOImage(image, None, None), param)
    stream.flush()
    return bytes(out.toByteArray())


def by_jvm(spark, data):
    return P.decode_png(rewritten(spark, data, "png"))


@pytest.mark.parametrize("progressive", [False, True])
@pytest.mark.parametrize("gray", [False, True])
def test_jpeg_as_the_jvm_reads_it(spark, progressive, gray):
    image = smooth()
    image = image[:, :, 0].copy() if gray else image
    data = rewritten(spark, P.encode_png(image), "jpg", progressive)
    assert (b"\xff\xc2" in data) == progressive
    got, want = codecs.decode(data), by_jvm(spark, data)
    assert got.shape == want.shape
    off = np.abs(got.astype(int) - want.astype(int))
    assert off.max() <= 4 and off.mean() < 1


@pytest.mark.parametrize("kind", ["bmp", "tif", "gif", "png"])
def test_other_formats_as_the_jvm_reads_them(spark, kind):
    for image in (smooth(), RNG.integers(0, 255, (40, 51, 3)).astype(np.uint8), smooth()[:, :, 0].copy()):
        data = rewritten(spark, P.encode_png(image), {"tif": "tiff"}.get(kind, kind), interlaced=kind in ("gif", "png"))
        assert codecs.kind_of(data) == kind
        got, want = codecs.decode(data), by_jvm(spark, data)
        assert (P.colour(got) == P.colour(want)).all()
        if kind in ("bmp", "png"):
            assert (P.colour(got) == P.colour(image)).all()


@pytest.mark.parametrize("quality", [95, 60, 10])
def test_jpegs_written_here_are_read_by_the_jvm(spark, quality):
    for image in (smooth(), smooth()[:, :, 2].copy(), RNG.integers(0, 255, (33, 47)).astype(np.uint8), np.full((5, 3, 3), 200, np.uint8)):
        data = codecs.encode_jpeg(image, quality)
        got, want = codecs.decode(data), by_jvm(spark, data)
        assert got.shape == image.shape and np.abs(got.astype(int) - want.astype(int)).max() <= 4
    assert np.abs(codecs.decode(codecs.encode_jpeg(smooth(), 95)).astype(int) - smooth()).mean() < 2
    sizes = [len(codecs.encode_jpeg(smooth(), q)) for q in (95, 60, 10)]
    assert sizes == sorted(sizes, reverse=True)


def test_bmps_written_here(spark):
    for image in (smooth(), smooth()[:, :, 1].copy()):
        data = codecs.encode_bmp(image)
        assert (codecs.decode(data) == image).all() and (P.colour(by_jvm(spark, data)) == P.colour(image)).all()


def png(w, h, depth, kind, rows, extra=b""):
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    return P.PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, kind, 0, 0, 0)) + extra + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_palette_and_deep_png():
    palette = bytes([255, 0, 0, 0, 255, 0, 0, 0, 255])
    plte = struct.pack(">I", 9) + b"PLTE" + palette + struct.pack(">I", zlib.crc32(b"PLTE" + palette))
    got = codecs.decode(png(4, 1, 2, 3, b"\0" + bytes([0b00011000]), plte))
    assert got.tolist() == [[[0, 0, 255], [0, 255, 0], [255, 0, 0], [0, 0, 255]]]
    assert codecs.decode(png(2, 1, 16, 0, b"\0\x12\x34\xab\xcd")).tolist() == [[0x12, 0xAB]]
    assert codecs.decode(png(3, 1, 1, 0, b"\0\xa0")).tolist() == [[255, 0, 255]]


def test_rows_of_mixed_filters():
    lines, kinds = RNG.integers(0, 255, (9, 12)).astype(np.uint8), np.array([4, 1, 3, 2, 4, 4, 3, 0, 4])
    whole = P._filtered_rows(np.concatenate([kinds[:, None].astype(np.uint8), lines], axis=1), 3)
    above = np.zeros(12, np.uint8)
    for kind, line, got in zip(kinds, lines, whole, strict=True):
        want = np.zeros(12, int)
        for i in range(12):
            a, b, c = (int(want[i - 3]) if i > 2 else 0), int(above[i]), (int(above[i - 3]) if i > 2 else 0)
            p = a + b - c
            guess = (0, a, b, (a + b) // 2, min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2])[kind]
            want[i] = (int(line[i]) + guess) & 255
        assert (got == want).all()
        above = want.astype(np.uint8)


def test_damaged_and_unknown_files_give_none(spark):
    image = P.encode_png(smooth())
    for kind in ("jpg", "bmp", "gif", "tiff", "png"):
        data = rewritten(spark, image, kind)
        for n in range(0, 40, 3):
            codecs.decode(data[:n])
        assert codecs.decode(data[:12]) is None
    assert codecs.decode(b"") is None and codecs.decode(b"RIFF\0\0\0\0WEBP") is None and codecs.decode(b"\xd7\xcd\xc6\x9a" * 9) is None
    short = codecs.decode(rewritten(spark, image, "jpg")[:-200])
    assert short is not None and short.shape == smooth().shape
