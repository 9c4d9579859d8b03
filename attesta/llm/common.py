"""Helpers shared by the corpus operators: tables, staged results, shard counts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import attesta

# Functions travel with the tasks, so workers need not have the package.
cloudpickle.register_pickle_by_value(attesta)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    A local session without the setting gets a temporary folder; a cluster
    without it is an error, since executors could not read each other's files.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="attesta-")
    context.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once below the shared folder and read it back.

    Cuts the lineage: later jobs read the files even if every executor that
    computed them is lost. Each call takes a folder of its own.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/attesta-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    result = spark.read.schema(df.schema).parquet(path)
    result.staged_paths = [path]
    return result


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table, or of all that `staged_paths` names."""
    jvm = df.sparkSession._jvm
    for name in df.staged_paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(df: DataFrame, megabytes: int = 4) -> DataFrame:
    """`df`, with the session's Arrow batches bounded in bytes.

    Texts vary from a few characters to many megabytes, so a batch of a fixed
    number of rows may take any amount of a Python worker's memory.
    """
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    conf.set(key, f"{megabytes << 20}b")
    return df


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_text(column: str) -> Column:
    """A whole-number id as text: pandas would make a column with nulls doubles."""
    return F.col(column).cast("bigint").cast("string")


def ids_of(column: pd.Series) -> pd.array:
    """The ids of a column that left Spark by `id_text`, exact, nulls kept."""
    return pd.array([None if value is None else int(value) for value in column.tolist()], "Int64")


def give_back() -> None:
    """Return freed memory of this Python worker to the system.

    Workers live on between tasks and share an executor's memory with the JVM; their
    allocators otherwise keep what the largest batch took.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(batches: Iterator) -> Iterator:
    """The batches of a task; freed memory goes back when the last one is done."""
    yield from batches
    give_back()
