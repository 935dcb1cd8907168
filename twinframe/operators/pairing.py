"""Geometric and photometric scores of image pairs. Keypoints are found once for each image and lie with it in files of the shared folder, where pairs look them up."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinframe.kernels import codecs, geometry, pixels
from twinframe.storage import discard, fresh_folder, materialised, opened_folder


@dataclass(frozen=True)
class Pairing:
    ratio: float = 0.75
    mutual: bool = True
    threshold: float = 5.0
    ssim: float = 0.80
    ncc: float = 0.65
    ecc: bool = True
    gradient: bool = True
    keypoints: int = geometry.KEYPOINTS
    rounds: int = geometry.ROUNDS
    confidence: float = 0.999


#: Images that leave described() at a time.
DESCRIBED = 16
#: Pairs of a task of scored(), and of one reference in one task, about.
TASK_PAIRS, REF_PAIRS = 2000, 64
#: Before an image's record: bytes of the picture, the points, the descriptors.
HEAD = "<3q"


def described(images: DataFrame, p: Pairing = Pairing()) -> DataFrame:
    """rel, png, points, descriptors of images (rel, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, DESCRIBED):
                batch, out = whole.slice(at, DESCRIBED), []
                for rel, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    image = codecs.decode(content or b"")
                    if image is not None:
                        points, found = geometry.keypoints(image, p.keypoints)
                        out.append((rel, content, points.astype("<f4").tobytes(), found.astype("<f4").tobytes()))
                yield pa.record_batch([pa.array([r[k] for r in out], pa.string() if not k else pa.binary()) for k in range(4)], ["rel", "png", "points", "descriptors"])

    return images.select("rel", "content").mapInArrow(run, "rel string, png binary, points binary, descriptors binary")


def placed(images: DataFrame, folder: str) -> DataFrame:
    """rel, file, at, size: where in the folder's files the rows of described() lie. Each is on disk once, however many pairs it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = opened_folder(folder)
        file, out, at = uuid.uuid4().int >> 65, None, 0
        try:
            for batch in batches:
                rows = []
                for rel, png, points, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out = out or fs.open_output_stream(f"{path}/{file:x}")
                    record = struct.pack(HEAD, len(png), len(points), len(found)) + png + pa.compress(points + found, "zstd", asbytes=True)
                    out.write(record)
                    rows.append((rel, file, at, len(record)))
                    at += len(record)
                yield pa.record_batch([pa.array([r[k] for r in rows], pa.int64() if k else pa.string()) for k in range(4)], ["rel", "file", "at", "size"])
        finally:
            if out:
                out.close()

    return images.select("rel", "png", "points", "descriptors").mapInArrow(run, "rel string, file long, at long, size long")


class Placed:
    """Reads records of placed(); the last few files stay open."""

    def __init__(self, folder: str, most: int = 64):
        (self.fs, self.path), self.most, self.files = opened_folder(folder), most, {}

    def read(self, file: int, at: int, size: int) -> tuple[bytes, bytes, bytes]:
        """An image's picture, points and descriptors."""
        held = self.files.pop(file, None) or self.fs.open_input_file(f"{self.path}/{file:x}")
        self.files[file] = held
        if len(self.files) > self.most:
            self.files.pop(next(iter(self.files))).close()
        record = held.read_at(size, at)
        png, points, found = struct.unpack_from(HEAD, record)
        begin = struct.calcsize(HEAD)
        arrays = pa.decompress(record[begin + png :], points + found, "zstd", asbytes=True)
        return record[begin : begin + png], arrays[:points], arrays[points:]

    def close(self) -> None:
        for f in self.files.values():
            f.close()


def scored(pairs: DataFrame, refs: DataFrame, extracted: DataFrame, p: Pairing = Pairing()) -> DataFrame:
    """pairs (ref, ex, cand_ord) with matches, inliers, inlier_ratio, reproj_rmse, score, ssim, ncc, gssim, ecc_used, homography (null and zeros without a fit).

    A warped image is refined only where its agreement is middling, which is the costly step; random sampling is seeded by the pair.
    """
    folder = fresh_folder(pairs.sparkSession, "described")
    tables = [materialised(placed(refs, folder), "placed")]
    tables.append(tables[0] if extracted is refs else materialised(placed(extracted, folder), "placed"))
    side = lambda df, name: df.select(F.col("rel").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("file", "at", "size")))
    met = pairs.select("ref", "ex", "cand_ord").join(side(tables[0], "ref"), "ref").join(side(tables[1], "ex"), "ex")
    met = materialised(met.select("ref", "ex", "cand_ord", F.xxhash64("ref", "ex").alias("seed"), *(f"{s}_{c}" for s in ("ref", "ex") for c in ("file", "at", "size"))), "met")
    for table in {id(t): t for t in tables}.values():
        discard(table)
    # a pair's row is small, its work is not: tasks by the number of pairs, a reference's pairs side by side
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-met.count() // TASK_PAIRS))
    met = met.repartition(tasks, F.col("ref"), F.floor(F.col("cand_ord") / REF_PAIRS)).sortWithinPartitions("ref", "cand_ord")
    schema = "ref string, ex string, cand_ord int, matches int, inliers int, inlier_ratio double, reproj_rmse double, score double, ssim double, ncc double, gssim double, ecc_used boolean, homography array<double>"

    def one(seed: int, a: bytes, ap: bytes, ad: bytes, b: bytes, bp: bytes, bd: bytes) -> tuple:
        points = [np.frombuffer(x, "<f4").reshape(-1, 2).astype(float) for x in (ap, bp)]
        found = [np.frombuffer(x, "<f4").reshape(-1, 128).astype(float) for x in (ad, bd)]
        matches = geometry.ratio_matches(*found, p.ratio, p.mutual)
        h, good, rmse = geometry.homography(points[0][matches[:, 0]], points[1][matches[:, 1]], seed & 0x7FFFFFFF, p.threshold, p.rounds, p.confidence)
        n, inliers = len(matches), int(good.sum())
        if h is None:
            return n, 0, 0.0, None, 0.0, 0.0, 0.0, 0.0, False, None
        x, y = (pixels.gray(codecs.decode(i)) for i in (a, b))
        y = geometry.warp_to_reference(x, y, h)
        similar, correlated, refined = geometry.ssim(x, y), geometry.ncc(x, y), False
        if p.ecc and (similar < max(0.9, p.ssim) or correlated < max(0.9, p.ncc)):
            moved = geometry.ecc_align(x, y)
            again = geometry.ssim(x, moved), geometry.ncc(x, moved)
            if again[0] > similar:
                y, (similar, correlated), refined = moved, again, True
        ratio = inliers / max(1, n)
        return n, inliers, ratio, rmse, inliers + 5.0 * ratio, similar, correlated, geometry.gradient_ssim(x, y) if p.gradient else 0.0, refined, h.ravel().tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 6, pa.bool_(), pa.list_(pa.float64())]
        images, last, ref = Placed(folder), None, ()
        for batch in batches:
            got = []
            for seed, *where in zip(*(batch.column(k).to_pylist() for k in range(3, 10)), strict=True):
                if where[:3] != last:
                    last, ref = where[:3], images.read(*where[:3])
                got.append(one(seed, *ref, *images.read(*where[3:])))
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2).cast(pa.int32()), *(pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds))], [f.split()[0] for f in schema.split(", ")])
        images.close()

    return met.mapInArrow(run, schema)
