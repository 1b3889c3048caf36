"""Working folder for tables a query must write before it can read them back."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster
    the executors would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/caderneta-{purpose}-{uuid.uuid4().hex}"


def put_away(df: DataFrame, path: str) -> None:
    """``df`` as a working table at ``path``, small on disk; shuffles that led to it may go."""
    df.write.option("compression", "zstd").parquet(path)
    release(df.sparkSession)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table of the working folder: computed once, however often it is read."""
    path = work_dir(df.sparkSession, purpose)
    put_away(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a working table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs.

    It does so when the driver's JVM collects their plans as garbage, which in a short
    run of large shuffles may otherwise not happen before the disks fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
