"""Byte streams in the shared folder, by any URI that pyarrow's file systems open (file, hdfs, s3, gs)."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from .shared import fresh_path


def fresh_folder(spark: SparkSession, name: str) -> str:
    path = fresh_path(spark, name)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)
    return path


def task_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of this task uses; the manifest names the files of the attempts that counted."""
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex[:12]}{suffix}"


def create(uri: str, buffer: int = 1 << 20):
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_output_stream(path, buffer_size=buffer)


def stream(uri: str, buffer: int = 1 << 20):
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_stream(path, buffer_size=buffer)


def random_access(uri: str):
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)
