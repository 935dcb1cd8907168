"""What the corpus operators share: shared-folder tables, bounded Arrow batches, byte-level text kernels."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a Python worker holds at a time.
SLICE_BYTES = 2 << 20
#: Short rows of one file of written().
ROWS_A_FILE = 100_000
#: Keys that may count as hot, at most, and rows that make none.
HOT_KEYS, LEAST_HOT = 10_000, 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Where none is set, a temporary one, on a local master only: on a cluster its files would be lost."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="twinframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path of its own in the shared folder; it is removed when this program ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove_late, spark, path)
    return path


def _remove_late(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may be gone by then
        pass


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends, not when the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, tag: str, rows: int | None = None, into: list[DataFrame] | None = None) -> DataFrame:
    """df, computed once and reread from a table in the shared folder: its lineage ends there, so a lost executor costs no recomputation of what came before.

    rows: a bound on df's rows, however many tasks make them; they go evenly into a file for each ROWS_A_FILE of it, as many as there are shuffle partitions at most.
    into: takes the table, for drop_written() once no later step reads it.
    """
    spark, schema, path = df.sparkSession, df.schema, fresh_path(df.sparkSession, tag)
    if rows is not None:
        df = df.repartition(max(2, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_FILE))))
    with shuffles_end(spark):
        df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._twinframe_path = path
    if into is not None:
        into.append(out)
    return out


def hot_limit(total: int) -> int:
    """Rows of one key, of `total`, that one task takes. At most HOT_KEYS keys can have more, whatever the data: their number is bounded before any broadcast."""
    return max(LEAST_HOT, total // HOT_KEYS)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, spread: list[str], how: str = "inner") -> DataFrame:
    """left joined with right, which has one row for each key, without a task for a hot key.

    hot: the keys of left with more than hot_limit() rows and `_salts`, into how many portions each is dealt (by a hash of left's columns `spread`); right's row goes to
    every portion. Left rows without a key are dealt too.
    """
    few, null = F.broadcast(hot), reduce(or_, (F.col(c).isNull() for c in on))
    portion = F.coalesce(F.pmod(F.xxhash64(*spread), F.col("__twinframe_salts")), F.when(null, F.pmod(F.xxhash64(*spread), F.lit(LEAST_HOT))), F.lit(0))
    one = left.join(few, on, "left").withColumn("__twinframe_portion", portion.cast("int")).drop("__twinframe_salts")
    two = right.join(few, on, "left").withColumn("__twinframe_portion", F.explode(F.sequence(F.lit(0), F.coalesce("__twinframe_salts", F.lit(1)).cast("int") - 1))).drop("__twinframe_salts")
    return one.join(two, [*on, "__twinframe_portion"], how).drop("__twinframe_portion")


def hot_keys(sizes: DataFrame, on: list[str], size: str, limit: int) -> DataFrame:
    """For spread_join: the keys of sizes with more than `limit` rows, and their portions."""
    return sizes.where(F.col(size) > limit).select(*on, F.ceil(F.col(size) / limit).cast("int").alias("__twinframe_salts"))


def drop_written(*tables: DataFrame) -> None:
    """Removes tables of written() that no later step reads."""
    for t in tables:
        remove(t.sparkSession, t._twinframe_path)


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about `most` bytes of text (a longer row stands alone)."""
    col = batch.column(batch.schema.get_field_index(column))
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int32)
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, int(offsets[at]) + most, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def map_slices(df: DataFrame, columns: list, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """fn over bounded slices of the named columns (one of them `text`); rows stay where they are, so nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                out = fn(piece)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.select(*columns).mapInArrow(run, schema)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and the n + 1 offsets of its rows. A null is empty."""
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; no run crosses a row's border."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = member.copy()
    begin[1:] &= ~member[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(member))]
    begin[edge] = member[edge]
    last = member.copy()
    last[:-1] &= ~member[1:]
    last[edge - 1] = member[edge - 1]
    return np.flatnonzero(begin), np.flatnonzero(last) + 1


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = SLICE_BYTES) -> np.ndarray:
    """A 64-bit hash of each non-empty run of bytes: a sum of scrambled (byte, distance from the run's start) terms, mixed with its length.

    Blocks of about `most` bytes of runs are hashed at once, so working memory stays bounded however long the rows are.
    """
    out, at, total = np.zeros(len(starts), np.uint64), 0, np.cumsum(ends - starts)
    while at < len(starts):
        done = int(total[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        out[at:end] = _run_hashes(data, starts[at:end], ends[at:end])
        at = end
    return out


def _run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lens = ends - starts
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    place = np.arange(total) - np.repeat(first, lens)
    with np.errstate(over="ignore"):
        term = _byte_table()[(place & 63) << 8 | data[np.repeat(starts, lens) + place]]
        if int(lens.max()) > 64:
            term = np.where(place > 63, mix(term + (place >> 6).astype(np.uint64)), term)
        return mix(np.add.reduceat(term, first) + lens.astype(np.uint64) * _MIX)


_TABLE: list[np.ndarray] = []


def _byte_table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(mix(np.arange(64 * 256, dtype=np.uint64), 77))
    return _TABLE[0]
