"""What the operators share with the cluster: a folder that every executor sees, and Arrow batch bounds."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_BYTES = "8m"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one where none is set and all runs on this machine (tests), else an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="curiospark-")
        sc.setCheckpointDir(found)
    return f"{found.rstrip('/')}/curiospark-{sc.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: a lost executor then costs no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def release(*tables: DataFrame) -> None:
    """Remove tables that ``keep`` gave, once nothing reads them any more."""
    for df in tables:
        drop_path(df.sparkSession, df._kept_at)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clean(spark: SparkSession) -> None:
    """Remove every table that the operators kept for this application."""
    drop_path(spark, shared_dir(spark))


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes, so that long texts don't add up to a whole executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def give_back() -> None:
    """Give freed memory back to the system: a worker process goes on to tasks of other operators, and keeps what it has else."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives its memory back when a task ends."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, whatever letters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0


def spread_over(df: DataFrame, size: int, *keys: Column | str) -> DataFrame:
    """Deal rows by ``keys`` to more tasks than the session's shuffles have where ``size`` bytes need them (128 MB each)."""
    tasks = size >> 27
    return df.repartition(tasks, *keys) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)
