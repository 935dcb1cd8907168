"""Stages from the command line: python -m twinframe.cli STAGE --help. Every option has the engine's default."""

from __future__ import annotations

import argparse
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinframe.functions import keys, measures
from twinframe.operators import candidates as C
from twinframe.operators import evaluation as E
from twinframe.operators import export, extraction, index, matching, pairing, patching
from twinframe.shipping import ship
from twinframe.sources import artifacts, containers, images


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="twinframe")
    stage = top.add_subparsers(dest="stage", required=True)

    a = stage.add_parser("extract", help="containers to a manifest and image files")
    a.add_argument("input"), a.add_argument("output")
    a.add_argument("-s", "--sample", type=int), a.add_argument("--min-bytes", type=int, default=0), a.add_argument("--include-preview", action="store_true")
    a.add_argument("--prefix", default="extracted_"), a.add_argument("--dry-run", action="store_true")

    a = stage.add_parser("preprocess", help="image files to variants")
    a.add_argument("input"), a.add_argument("output"), a.add_argument("--category", choices=("reference", "extracted"), required=True)
    a.add_argument("--low-size", type=int, default=640), a.add_argument("--high-size", type=int, default=1280), a.add_argument("--enable-high", action="store_true")
    a.add_argument("--pad-mode", choices=("none", "constant", "edge", "reflect"), default="edge"), a.add_argument("--pad-multiple", type=int, default=16)
    a.add_argument("--colorspace", choices=("none", "lab"), default="lab"), a.add_argument("--gray-clahe", action="store_true"), a.add_argument("--trim", choices=("auto", "none"), default="auto")
    a.add_argument("--only-refs"), a.add_argument("--feedback-in"), a.add_argument("--max-files", type=int, default=0)

    a = stage.add_parser("candidates", help="features of two categories to candidate pairs")
    a.add_argument("references"), a.add_argument("extracted"), a.add_argument("--out", required=True)
    a.add_argument("--phash-threshold", type=int, default=28), a.add_argument("--phash-step", type=int, default=2), a.add_argument("--phash-max", type=int, default=36)
    a.add_argument("--hist-threshold", type=float, default=0.70), a.add_argument("--min-cand-per-basis", type=int, default=5)
    a.add_argument("--prefilter-aspect", type=float, default=0.50), a.add_argument("--prefilter-edge", type=float, default=0.30)
    a.add_argument("--feedback-in"), a.add_argument("--only-refs")

    a = stage.add_parser("match", help="candidates to scores and an assignment")
    a.add_argument("--feedback-in")
    a.add_argument("references"), a.add_argument("extracted"), a.add_argument("--candidates", required=True), a.add_argument("--out", required=True)
    a.add_argument("--ratio", type=float, default=0.75), a.add_argument("--mutual-check", action="store_true"), a.add_argument("--ransac-th", type=float, default=5.0)
    a.add_argument("--min-inliers", type=int, default=12), a.add_argument("--min-inlier-ratio", type=float, default=0.22), a.add_argument("--enable-recall-sweep", action="store_true")
    a.add_argument("--min-inliers-b", type=int, default=8), a.add_argument("--min-inlier-ratio-b", type=float, default=0.15)
    a.add_argument("--top2-margin", type=float, default=4.0), a.add_argument("--top2-multiplier", type=float, default=1.25)
    a.add_argument("--verify-photometric", action="store_true"), a.add_argument("--ssim-th", type=float, default=0.80), a.add_argument("--ncc-th", type=float, default=0.65)
    a.add_argument("--enable-ecc", action="store_true"), a.add_argument("--use-gssim", action="store_true")
    a.add_argument("--assign", choices=("greedy", "reuse"), default="greedy"), a.add_argument("--max-cands-per-ref", type=int, default=64)

    a = stage.add_parser("evaluate", help="an assignment against labels, with suggestions and feedback")
    a.add_argument("scores"), a.add_argument("mapping"), a.add_argument("references"), a.add_argument("--out", required=True), a.add_argument("--labels-csv")
    a.add_argument("--suggest-n", type=int, default=20), a.add_argument("--suggest-only-unmatched", action="store_true")
    a.add_argument("--suspect-ssim", type=float, default=0.90), a.add_argument("--suspect-ncc", type=float, default=0.85)
    a.add_argument("--suspect-top2-margin", type=float, default=6.0), a.add_argument("--suspect-top2-multiplier", type=float, default=1.40)

    a = stage.add_parser("patch", help="replacement images into documents")
    a.add_argument("documents"), a.add_argument("replacements", nargs="?"), a.add_argument("--out", required=True), a.add_argument("--limit", type=int, default=0)
    a.add_argument("--mapping"), a.add_argument("--manifest"), a.add_argument("--references"), a.add_argument("--files")
    a.add_argument("--jpeg-q-start", type=int, default=95), a.add_argument("--jpeg-q-min", type=int, default=10), a.add_argument("--jpeg-q-step", type=int, default=5)
    a.add_argument("--downscale", default="0.9,0.8,0.7,0.6,0.5")
    return top


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    files = spark.read.format("binaryFile").load(a.input).select("path", "content")
    found = containers.guarded_inflate(containers.entries(spark, files))
    parts = [extraction.named_entries(found.where(F.col("kind") == kind), kind, a.include_preview, a.sample) for kind in ("hwpx", "hwp")]
    kept = parts[0].unionByName(parts[1])
    listed = extraction.manifest(kept, a.prefix, a.min_bytes)
    if a.dry_run:
        listed.groupBy("doc").count().show(truncate=False)
        return
    export.manifest_document(listed).write.mode("overwrite").text(f"{a.output}/manifest")
    pictures = listed.join(kept.select("doc", F.col("name").alias("source"), "content"), ["doc", "source"])
    export.files(pictures.withColumn("out_path", F.concat(F.sha2("doc", 256), F.lit("/"), "out_path")), f"{a.output}/files").write.mode("overwrite").parquet(f"{a.output}/written")


def _below(spark: SparkSession, folder: str) -> DataFrame:
    """rel and content of a folder's images."""
    # Spark's paths carry a scheme, so the root is found by its own name
    name = re.escape(folder.rstrip("/").rsplit("/", 1)[-1])
    return images.folder(spark, folder).select(F.regexp_replace("path", f"^.*?/{name}/", "").alias("rel"), "content")


def preprocess(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = _below(spark, a.input)
    only = artifacts.listed(spark, a.only_refs) if a.only_refs else None
    rows = index.selected(rows, artifacts.targets(spark, a.feedback_in) if a.feedback_in else None, only, "rel")
    if a.max_files:
        rows = rows.orderBy("rel").limit(a.max_files)
    made = images.variants(rows, a.low_size, a.high_size if a.enable_high else None, a.pad_mode, a.pad_multiple, a.trim == "auto", a.colorspace == "lab", a.gray_clahe)
    made.withColumn("category", F.lit(a.category)).write.mode("overwrite").parquet(a.output)
    lost = rows.join(spark.read.parquet(a.output).select("rel").distinct(), "rel", "left_anti")
    images.unreadable(lost).write.mode("overwrite").parquet(f"{a.output.rstrip('/')}_unreadable")


def _featured(spark: SparkSession, path: str):
    low = spark.read.parquet(path).where("track = 'low' AND channel = 'color'").select("rel", F.col("png").alias("content"))
    return images.features(low).withColumn("phash", measures.pack_hash(F.col("block")))


def candidates(spark: SparkSession, a: argparse.Namespace) -> None:
    s = C.Settings(a.phash_threshold, a.phash_step, a.phash_max, a.hist_threshold, a.min_cand_per_basis, a.prefilter_aspect, a.prefilter_edge)
    refs, others = _featured(spark, a.references), _featured(spark, a.extracted)
    refs = index.selected(refs, artifacts.targets(spark, a.feedback_in) if a.feedback_in else None, artifacts.listed(spark, a.only_refs) if a.only_refs else None, "rel")
    C.candidates(refs, others, s, artifacts.overrides(spark, a.feedback_in) if a.feedback_in else None).write.mode("overwrite").parquet(a.out)


def match(spark: SparkSession, a: argparse.Namespace) -> None:
    sides = [pairing.described(spark.read.parquet(p).where("track = 'low' AND channel = 'gray'").select("rel", F.col("png").alias("content"))) for p in (a.references, a.extracted)]
    found = spark.read.parquet(a.candidates).where(F.col("cand_ord") <= a.max_cands_per_ref)
    p = pairing.Pairing(a.ratio, a.mutual_check, a.ransac_th, a.ssim_th, a.ncc_th, a.enable_ecc, a.use_gssim)
    pairing.scored(found, sides[0], sides[1], p).write.mode("overwrite").parquet(f"{a.out}/scores")
    r = matching.Rules(a.min_inliers, a.min_inlier_ratio, a.enable_recall_sweep, a.min_inliers_b, a.min_inlier_ratio_b, a.verify_photometric, a.ssim_th, a.ncc_th, a.top2_margin, a.top2_multiplier)
    overrides = artifacts.tightened(spark, a.feedback_in) if a.feedback_in else None
    matching.classified(spark.read.parquet(f"{a.out}/scores"), r, overrides, a.max_cands_per_ref).write.mode("overwrite").parquet(f"{a.out}/pairs")
    pairs = spark.read.parquet(f"{a.out}/pairs")
    done = matching.assign_greedy(pairs) if a.assign == "greedy" else matching.assign_reuse(pairs)
    done.write.mode("overwrite").parquet(f"{a.out}/assigned")


def evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    pairs, done = spark.read.parquet(a.scores), spark.read.parquet(a.mapping)
    refs = spark.read.parquet(a.references).select("rel").distinct()
    labels = E.labels(artifacts.rows(spark, a.labels_csv)) if a.labels_csv else spark.createDataFrame([], "ref string, ex string")
    suspects = matching.assigned_suspects(pairs, done)
    E.evaluation(done, matching.unassigned(refs, done), labels).write.mode("overwrite").json(f"{a.out}/report")
    more = E.suggestions(pairs.drop("rank"), done, a.suggest_n, a.suggest_only_unmatched)
    numbers = ("score", "inlier_ratio", "ssim", "ncc", "top2_margin", "top2_multiplier")
    export.csv(more.select("ref", "rank", "ex", "inliers", "phase", *numbers), f"{a.out}/suggestions", numbers)
    t = E.Thresholds(a.suspect_ssim, a.suspect_ncc, a.suspect_top2_margin, a.suspect_top2_multiplier)
    actions = E.feedback(refs, pairs, done, suspects, t)
    E.feedback_document(actions, E.reuse_hint(pairs), matching.match_stats(refs, done)).write.mode("overwrite").text(f"{a.out}/feedback")


def patch(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = spark.read.format("binaryFile").load(a.documents).select(F.col("path").alias("doc"), "content")
    if a.replacements:
        todo = spark.read.parquet(a.replacements)
    elif a.mapping and a.manifest and a.references:
        pairs = spark.read.parquet(a.mapping).select((-F.col("score")).alias("ord"), "ref", "ex")
        listed = artifacts.manifest(spark, a.manifest, lines=True).withColumnRenamed("source_file", "doc")
        todo = index.replacements(pairs, listed, _below(spark, a.references).withColumnRenamed("rel", "ref"))
    else:
        raise SystemExit("patch takes a table of replacements, or --mapping, --manifest and --references")
    if a.limit:
        todo = todo.orderBy("doc", "stream").limit(a.limit)
    sizes = spark.range(1).select(extraction.scales(a.downscale).alias("s")).first().s
    e = patching.Encoding(a.jpeg_q_start, a.jpeg_q_min, a.jpeg_q_step, tuple(sizes))
    patching.patched(docs, todo, e).write.mode("overwrite").parquet(a.out)
    done = spark.read.parquet(a.out)
    extraction.patch_summary(done).show()
    if a.files:
        # documents of equal name in several folders stay apart by their own folder's digest
        named = done.where("content IS NOT NULL").select(F.concat(F.sha2("doc", 256), F.lit("/"), keys.base_name(F.col("doc"))).alias("name"), "content")
        export.files(named, a.files, "name").write.mode("overwrite").parquet(f"{a.out.rstrip('/')}_files")


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"twinframe {a.stage}").getOrCreate()
    ship(spark)
    globals()[a.stage](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
