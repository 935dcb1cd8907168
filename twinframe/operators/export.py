"""Artifacts for people and other programs. Parquet tables stay the base; numbers in CSVs have six decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def six(name: str) -> Column:
    return F.format_string("%.6f", F.coalesce(F.col(name).cast("double"), F.lit(0.0))).alias(name)


def csv(df: DataFrame, path: str, numbers: tuple[str, ...] = ()) -> None:
    """One header in each file; booleans as 0 and 1."""
    kinds = dict(df.dtypes)
    columns = [six(c) if c in numbers else F.col(c).cast("int").alias(c) if kinds[c] == "boolean" else F.col(c) for c in df.columns]
    df.select(columns).write.mode("overwrite").option("header", True).csv(path)


def manifest_document(manifest: DataFrame) -> DataFrame:
    """One JSON document for each container: source_file, total_extracted, items."""
    item = F.struct(F.col("ord").alias("order"), "source", "out_path", "ext", "bytes", "mime")
    grouped = manifest.groupBy(F.col("doc").alias("source_file")).agg(F.count("*").alias("total_extracted"), F.array_sort(F.collect_list(item)).alias("items"))
    return grouped.select(F.to_json(F.struct("source_file", "total_extracted", "items")).alias("value"))


def candidate_lines(found: DataFrame) -> DataFrame:
    """One JSON line for each reference with its candidates in order: no reference's list grows beyond its cap, and no document holds them all."""
    item = F.struct("cand_ord", F.col("ex").alias("extracted"), "phash_dist", "hist_dist")
    return found.groupBy(F.concat(F.lit("low|"), "ref").alias("key")).agg(F.array_sort(F.collect_list(item)).alias("candidates")).select(F.to_json(F.struct("key", "candidates")).alias("value"))


def result_lines(assigned: DataFrame, unassigned: DataFrame) -> DataFrame:
    """One JSON line for each reference: its partner, or that it has none."""
    done = assigned.select(F.to_json(F.struct(F.lit("assigned").alias("state"), "*")).alias("value"))
    return done.unionByName(unassigned.select(F.to_json(F.struct(F.lit("unassigned").alias("state"), "ref")).alias("value")))


def files(rows: DataFrame, folder: str, name: str = "out_path", content: str = "content") -> DataFrame:
    """Writes each row's content to folder/name through Hadoop's file system, one task for its own rows; returns name and bytes of what was written.

    A file that exists is replaced, so a repeated task leaves the same files.
    """
    target = folder.rstrip("/")

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        root, base = fs.FileSystem.from_uri(target)
        root.create_dir(base, recursive=True)
        for batch in batches:
            names, sizes = [], []
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{base}/{n}"
                root.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with root.open_output_stream(path) as out:
                    out.write(data or b"")
                names.append(n)
                sizes.append(len(data or b""))
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["name", "bytes"])

    return rows.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInArrow(run, "name string, bytes long")
