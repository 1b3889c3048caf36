"""Numbered versions of a small table in a folder: the last finished one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def finished_versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the versions whose write has succeeded, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path(folder)):
        return []
    found = []
    for entry in files.listStatus(path(folder)):
        name = entry.getPath().getName()
        if name.startswith("versao=") and files.exists(path(entry.getPath(), "_SUCCESS")):
            found.append(int(name.removeprefix("versao=")))
    return sorted(found)


def read_version(spark: SparkSession, folder: str, schema: str, version: int | None = None) -> DataFrame:
    """The last version, or the one asked for; empty before the first."""
    known = finished_versions(spark, folder)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/versao={version or known[-1]}")


def write_version(table: DataFrame, folder: str) -> int:
    """Writes the next version; it counts from the moment its write has succeeded.

    Whatever a dead run has left of a number that never counted is written over.
    """
    version = (finished_versions(table.sparkSession, folder) or [0])[-1] + 1
    table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/versao={version}")
    return version
