"""New images upsert the variant index as they arrive: an extension, keyed like the batch upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinframe.functions import keys
from twinframe.operators.index import upsert

SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def hashed(files: DataFrame, category: str) -> DataFrame:
    """category, src_relpath, content_hash, bytes of image files (path, content)."""
    return files.where(keys.is_image_file(F.col("path"))).select(F.lit(category).alias("category"), keys.base_name(F.col("path")).alias("src_relpath"), F.sha2("content", 256).alias("content_hash"), F.length("content").cast("long").alias("bytes"))


def ingest(spark: SparkSession, folder: str, index_root: str, checkpoint: str, category: str = "extracted"):
    """Starts a query over new files of `folder`; each batch writes a new version of the index under index_root. A repeated batch writes the same version again."""
    files = spark.readStream.format("binaryFile").schema(SCHEMA).option("recursiveFileLookup", "true").load(folder)

    def one(batch: DataFrame, number: int) -> None:
        new = hashed(batch, category)
        if number:
            new = upsert(batch.sparkSession.read.parquet(f"{index_root}/v={number - 1}"), new, ["category", "src_relpath"])
        new.write.mode("overwrite").parquet(f"{index_root}/v={number}")

    return files.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
