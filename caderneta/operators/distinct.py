"""Exact distinct counts that merge: one bit for each value, one set of bitmaps a month.

A distinct count cannot be added up over months, its bitmap can: months are joined by OR,
and the items are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caderneta.functions.dates import month_text
from caderneta.scratch import written

# Values of a part are numbered by one task.
PART_VALUES = 1 << 20
FIRST_DAY = "yyyy-MM-dd"


def value_numbers(items: DataFrame, column: str) -> DataFrame:
    """Each distinct value with a number: ``valor``, ``parte`` and ``numero``, from 0 in its part.

    Parts go by hash, as many as the counted values need, so that no task numbers more than
    some ``PART_VALUES``.  Null is no value.
    """
    value = F.col(column)
    values = written(
        items.filter(value.isNotNull()).select(value.alias("valor")).distinct(), "valores"
    )
    parts = 1 + values.count() // PART_VALUES
    within = Window.partitionBy("parte").orderBy("valor")
    return values.withColumn("parte", F.pmod(F.xxhash64("valor"), F.lit(parts))).withColumn(
        "numero", F.row_number().over(within).cast("bigint") - 1
    )


def month_bitmaps(items: DataFrame, column: str, date: str = "data_emissao") -> DataFrame:
    """Which values of ``column`` each month has: ``mes``, ``parte``, ``balde`` and ``bits``.

    A row holds 32,768 values of a part.  Undated items form the month ``NaT``.  Values are
    folded per month before they meet their numbers, so a hot value is one row a task.
    """
    numbers = value_numbers(items, column)
    value = F.col(column)
    seen = (
        items.filter(value.isNotNull())
        .select(month_text(F.col(date)).alias("mes"), value.alias("valor"))
        .distinct()
    )
    # Spark numbers the bits from 1.
    place = F.col("numero") + 1
    return (
        seen.join(numbers, "valor")
        .groupBy("mes", "parte", F.bitmap_bucket_number(place).alias("balde"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    )


def distinct_in_ranges(bitmaps: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per range of months (``inicio``, ``fim``, both ``yyyy-MM``, inclusive): ``distintos``.

    A range without any month in ``bitmaps`` counts 0; repeated ranges are one.
    """
    first, last = (F.to_date(F.concat(c, F.lit("-01")), FIRST_DAY) for c in ("inicio", "fim"))
    wanted = ranges.select("inicio", "fim").distinct()
    # A range that ends before it begins has no month.
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    by_month = wanted.select("inicio", "fim", F.explode(months).alias("dia"))
    joined = by_month.withColumn("mes", F.date_format("dia", "yyyy-MM")).join(bitmaps, "mes")
    merged = joined.groupBy("inicio", "fim", "parte", "balde").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")
    )
    counts = merged.groupBy("inicio", "fim").agg(F.sum("n").alias("distintos"))
    return wanted.join(counts, ["inicio", "fim"], "left").fillna(0, ["distintos"])
