"""Stage results that several later plans read."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    A local session without the setting gets a temporary folder; on a cluster
    the setting is required.
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


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """What is run inside deletes its shuffle files when it ends; otherwise they stay
    until the driver collects its garbage. The session's setting is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write a frame once as Parquet and read it back.

    Later plans read only the columns they need, know the table's size, and do
    not depend on the executors that computed it. `path` is a shared folder of
    the caller's choice; without it a new one below the shared folder is taken.
    `codec` is Spark's compression of Parquet; the session's without it.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/attesta-staged-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    with shuffles_deleted(spark):
        (writer.option("compression", codec) if codec else writer).parquet(path)
    result = spark.read.schema(df.schema).parquet(path)
    result.staged_paths = [path]
    return result


def unstage(df: DataFrame, *more: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for frame in (df, *more):
        for name in frame.staged_paths:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
