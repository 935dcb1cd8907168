"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a side may be broadcast; it is measured first.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a temporary one, on a local master only: on a cluster its files would be lost."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="twinframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A folder of its own in the shared folder, for files that tasks write; it goes when this program ends."""
    uri = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    atexit.register(_delete_late, spark, uri)
    return uri


def opened_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """A folder as tasks read and write it."""
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def materialised(df: DataFrame, tag: str) -> DataFrame:
    """df, computed once and reread from a table in the shared folder, which goes when this program ends."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._twinframe_path = path
    atexit.register(_discard_late, out)
    return out


def discard(table: DataFrame) -> None:
    """Removes a table of materialised() that no later step reads."""
    _delete(table.sparkSession, table._twinframe_path)


def _delete(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _delete_late(spark: SparkSession, uri: str) -> None:
    try:
        _delete(spark, uri)
    except Exception:  # the session may be gone by then
        pass


def _discard_late(table: DataFrame) -> None:
    try:
        discard(table)
    except Exception:  # the session may be gone by then
        pass


def within(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> bool:
    """Whether df's rows, at `row_bytes` each, stay within `most` bytes: the check before a broadcast."""
    return df.select(F.count("*")).first()[0] * row_bytes <= most
