"""A stored table of items by month, of which an update writes only the months that changed.

``dados/lote=../mes=..`` holds the items of the months that one update wrote.  The manifest
has a row per month: the file that won it, a sum over its rows and the batch they stand in.
An update writes its batch first and the next version of the manifest then, so one that
dies in between leaves all months as they were; other months' files are not touched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caderneta.functions.dates import month_text
from caderneta.operators.calendar import DATE, FILE, supersede_partial
from caderneta.plans.versions import read_version, write_version
from caderneta.schemas import ITEM
from caderneta.scratch import discard, put_away, release, work_dir

MONTH = "mes"
MANIFEST = "mes string, arquivos string, linhas long, soma decimal(38,0), lote string"


def month_sums(items: DataFrame) -> DataFrame:
    """(mes, arquivos, linhas, soma): equal for equal rows, in whatever order and files they stand."""
    row = F.xxhash64(F.to_json(F.struct(*ITEM.fieldNames())))
    return items.groupBy(MONTH).agg(
        F.array_join(F.array_sort(F.collect_set(FILE)), ",").alias("arquivos"), F.count(F.lit(1)).alias("linhas"),
        F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("soma"),
    )


def stored_months(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The items that a version of the manifest stands for, with their month."""
    of = read_version(spark, f"{table}/manifesto", MANIFEST, version).select(MONTH, "lote")
    batches = [r["lote"] for r in of.select("lote").distinct().collect()]
    if not batches:
        return spark.createDataFrame([], ITEM).withColumn(MONTH, F.lit(None).cast("string"))
    # Months are read as text: one of them is called NaT.
    schema = T.StructType([*ITEM.fields, *(T.StructField(c, T.StringType()) for c in (MONTH, "lote"))])
    stored = spark.read.schema(schema).option("basePath", f"{table}/dados").parquet(
        *[f"{table}/dados/lote={b}" for b in batches]
    )
    return stored.join(of, [MONTH, "lote"]).select(*ITEM.fieldNames(), MONTH)


def replace_months(items: DataFrame, table: str) -> list[str]:
    """Brings the stored table up to ``items``; returns the months written, ascending.

    Partial files give way to full ones first (``supersede_partial``).  A month is written
    if its rows differ from those stored, counted with their copies.  A month that ``items``
    has no rows of leaves the manifest.  What is kept of the items goes into a working table, from
    which sums and months are read, so the items are computed for ``supersede_partial`` alone.
    """
    spark = items.sparkSession
    table = table.rstrip("/")
    path = work_dir(spark, "mantidos")
    superseded = supersede_partial(items.select(*ITEM.fieldNames()))
    put_away(superseded, path)
    kept = spark.read.schema(superseded.schema).parquet(path).withColumn(MONTH, month_text(F.col(DATE)))
    known = read_version(spark, f"{table}/manifesto", MANIFEST)
    now = month_sums(kept)
    batch = uuid.uuid4().hex
    old = known.select(MONTH, F.col("linhas").alias("_n"), F.col("soma").alias("_s"), F.col("lote").alias("_lote"))
    same = (F.col("linhas") == F.col("_n")) & (F.col("soma") == F.col("_s"))
    told = now.join(old, MONTH, "left").withColumn("lote", F.when(same, F.col("_lote")).otherwise(F.lit(batch)))
    # One row a month: few, whatever the number of items.
    rows = [tuple(r) for r in told.select(MONTH, "arquivos", "linhas", "soma", "lote").collect()]
    changed = sorted(r[0] for r in rows if r[4] == batch)
    if changed:
        fresh = kept.filter(F.col(MONTH).isin(changed))
        fresh.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{table}/dados/lote={batch}")
    discard(spark, path)
    release(spark)
    if changed or len(rows) != known.count():
        write_version(spark.createDataFrame(rows, MANIFEST), f"{table}/manifesto")
    return changed
