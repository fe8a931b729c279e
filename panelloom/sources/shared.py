"""Intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, default: str | None = None) -> str:
    """The cluster's checkpoint folder. A default is used only where none is configured."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if folder is None:
        raise ValueError("spark.checkpoint.dir is not set; pass a shared folder")
    return folder


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have an intermediate table removed when the program ends."""
    context = spark.sparkContext

    def remove() -> None:
        if context._jsc is not None and not context._jsc.sc().isStopped():
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)

    atexit.register(remove)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and kept as a table until the program ends.

    For steps whose result must not differ between two readings, such as the number of the partition
    that a row is in. A stored table also outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
