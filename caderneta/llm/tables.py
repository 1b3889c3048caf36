"""Helpers the operators share: reading, writing back, word columns, ordered sums."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caderneta.scratch import release, work_dir

# The white space of the contract: blank and U+0009 to U+000D.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

HASH_BITS = 60
BLOCK_BITS = 12
COPIES_AT_ONCE = 65536


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends in a file."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.stored_at = path
    return written


def discard(*tables: DataFrame) -> None:
    """Deletes the files of stored tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, *keys: Column | str, values: list[Column | str]) -> DataFrame:
    """``keys`` and ``values`` of ``df``, with each value computed once a row.

    Spark moves a filter below the projections it reads and writes their expressions out
    at every use, so that one on a split text splits it again for each array element.  It
    moves none below a generator that makes the column.
    """
    return df.select(*keys, F.inline(F.array(F.struct(*values))))


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of bounded size from the driver, as one literal that Spark itself reads.

    ``schema`` names its columns as ``name type, ...``; floats keep all their digits.
    """
    names = [column.split()[0] for column in schema.split(", ")]
    listed = json.dumps([dict(zip(names, row)) for row in rows], ensure_ascii=False)
    typed = ", ".join(": ".join(column.split(" ", 1)) for column in schema.split(", "))
    one = spark.range(1).select(F.from_json(F.lit(listed), f"array<struct<{typed}>>").alias("rows"))
    return one.select(F.inline("rows"))


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    split = F.split(F.coalesce(text, F.lit("")), BLANK)
    return F.filter(split, lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_hash(*parts: Column | str) -> Column:
    """The first 60 bits of the MD5 of the parts as text; nulls read ``null``.

    MD5 rather than a faster hash, so that SQL elsewhere can state the same value.
    """
    shown = [F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("null"))
             for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", *shown)), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def row_key(*parts: Column | str) -> Column:
    """A text that is equal for rows equal in ``parts``, nulls included, and never null."""
    named = [(F.col(p) if isinstance(p, str) else p).alias(f"k{n}") for n, p in enumerate(parts)]
    return F.md5(F.to_json(F.struct(*named)))


def packed(docs: DataFrame, *parts: Column | str) -> DataFrame:
    """(key, row): ``docs`` as one struct each, so that no helper column meets theirs."""
    return docs.select(row_key(*parts).alias("key"), F.struct("*").alias("row"))


def running_starts(
    rows: DataFrame, group: str, order: str, value: Column, start: str = "start"
) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each, by ``order`` in its group.

    ``order`` is a 60-bit hash; ties go by the other columns.  A group may hold any share
    of the rows: equal rows are counted before the shuffle, the rest fall into 4,096
    hash blocks, and only block totals are summed up along the whole group.  Rows equal
    in all columns follow each other.
    """
    named = rows.columns
    folded = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("_n"))
    folded = folded.withColumns({
        "_blk": F.shiftright(F.col(order), HASH_BITS - BLOCK_BITS).cast("int"),
        "_v": value.cast("long"),
    })
    blocks = folded.groupBy(group, "_blk").agg(F.sum(F.col("_v") * F.col("_n")).alias("_sum"))
    along = Window.partitionBy(group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col(group).alias("_g"), F.col("_blk").alias("_b"),
        F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_before"),
    )
    rest = [c for c in named if c not in (group, order)]
    inside = (
        Window.partitionBy(group, "_blk").orderBy(order, *rest)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = folded.withColumn(
        "_local", F.coalesce(F.sum(F.col("_v") * F.col("_n")).over(inside), F.lit(0))
    )
    placed = local.join(
        blocks, local[group].eqNullSafe(blocks["_g"]) & (local["_blk"] == blocks["_b"])
    )
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_AT_ONCE))
    at = F.col("_chunk") * COPIES_AT_ONCE
    copies = F.sequence(at, F.least(at + (COPIES_AT_ONCE - 1), F.col("_n") - 1))
    return (
        placed.withColumn("_chunk", F.explode(chunks))
        .withColumn("_copy", F.explode(copies))
        .select(
            *named,
            (F.col("_before") + F.col("_local") + F.col("_copy") * F.col("_v")).alias(start),
        )
    )
