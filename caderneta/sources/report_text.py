"""Print-page text files (latin-1) as ``report_lines``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.functions.text import base_name
from caderneta.operators.report_fixed import (
    LINE_LENGTH,
    analytic_sales,
    purchases,
    synthetic_sales,
)

ENCODING = "ISO-8859-1"


def read_report_lines(spark: SparkSession, *paths: str, glob: str = "*.rel") -> DataFrame:
    """``report_lines(arquivo_origem, blk, seq, line)`` of full-length lines.

    The text source keeps a line's bytes as they are but calls them UTF-8; going
    through binary decodes them properly.  Big files are read in splits: ``blk`` is
    the split's start and ``seq`` rises within it, so line order survives without
    reading a file in one task.  ``arquivo_origem`` is the path: files of one name in
    two folders stay two files.
    """
    raw = spark.read.option("pathGlobFilter", glob).text(list(paths))
    return raw.select(
        F.col("_metadata.file_path").alias("arquivo_origem"),
        F.col("_metadata.file_block_start").alias("blk"),
        F.monotonically_increasing_id().alias("seq"),
        F.decode(F.col("value").cast("binary"), ENCODING).alias("line"),
    ).filter(F.length("line") >= LINE_LENGTH)


def _named(items: DataFrame) -> DataFrame:
    """Items with the file's name in place of its path."""
    return items.withColumn("arquivo_origem", base_name(F.col("arquivo_origem")))


def read_synthetic_sales(spark: SparkSession, *paths: str, glob: str = "*.rel") -> DataFrame:
    return _named(synthetic_sales(read_report_lines(spark, *paths, glob=glob)))


def read_analytic_sales(spark: SparkSession, *paths: str, glob: str = "*.rel") -> DataFrame:
    return _named(analytic_sales(read_report_lines(spark, *paths, glob=glob)))


def read_purchases(spark: SparkSession, *paths: str, glob: str = "*.rel") -> DataFrame:
    return _named(purchases(read_report_lines(spark, *paths, glob=glob)))
