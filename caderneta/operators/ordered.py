"""Ordered operators that stay parallel however large one group is.

A running maximum or a row number over ``partitionBy(file)`` puts a whole file in
one task.  Here rows are grouped into blocks of bounded size; each block is
reduced to one row, a running total over those few rows gives what each block
inherits from the blocks before it, and rows only ever meet their own block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]


def never_null(name: str) -> Column:
    """The column, failing the job on a null: such a row has no place in the order."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"null in {name}, which orders the rows")))


def _total(how: str, column: str) -> Column:
    return F.max(column) if how == "max" else F.sum(column)


def _combine(how: str, left: str, right: str) -> Column:
    if how == "max":
        return F.greatest(left, right)
    return F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))


def carry(
    blocks: DataFrame,
    keys: Names,
    levels: Sequence[Names],
    values: Names,
    how: str = "max",
) -> DataFrame:
    """Replace each value by the max (or sum) over all earlier blocks.

    ``blocks`` has one row per ``keys`` and all level columns; blocks order by the
    levels from coarse to fine.  A coarse level splits the running total again, so
    that no task holds all the blocks of a group either.
    """
    # A null key fails here.  The filter then drops nothing; it spares the join below its
    # own null filter on one side, so both uses of ``blocks`` share one scan and shuffle.
    spot = [*keys, *[name for level in levels for name in level]]
    blocks = blocks.withColumns({name: never_null(name) for name in spot})
    blocks = blocks.filter(" AND ".join(f"`{name}` IS NOT NULL" for name in spot))
    *outer, inner = levels
    upper = [name for level in outer for name in level]
    group = [*keys, *upper]
    running = (
        Window.partitionBy(*group).orderBy(*inner).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = {v: _total(how, v).over(running) for v in values}
    if not outer:
        return blocks.withColumns(within)
    coarse = blocks.groupBy(*group).agg(*[_total(how, v).alias(v) for v in values])
    above = carry(coarse, keys, outer, values, how).withColumnsRenamed(
        {v: f"{v}_above" for v in values}
    )
    joined = blocks.withColumns(within).join(above, group)
    merged = joined.withColumns({v: _combine(how, v, f"{v}_above") for v in values})
    return merged.drop(*[f"{v}_above" for v in values])


def running_max(
    df: DataFrame,
    keys: Names,
    levels: Sequence[Names],
    seq: str,
    value: str,
    output: str,
    local: Names | None = None,
) -> DataFrame:
    """Largest ``value`` up to and including each row, in order of levels and seq.

    ``local`` names those of the keys and levels that decide the others; rows are then
    shuffled by them alone, as later windows over the same columns need.
    """
    spot = [*keys, *[name for level in levels for name in level]]
    local = list(local or spot)
    blocks = df.groupBy(*spot).agg(F.max(value).alias("_carried"))
    inherited = carry(blocks, keys, levels, ["_carried"], "max").select(*local, "_carried")
    so_far = (
        Window.partitionBy(*local).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        df.join(inherited, local)
        .withColumn(output, F.greatest("_carried", F.max(value).over(so_far)))
        .drop("_carried")
    )


def row_offsets(df: DataFrame, keys: Names, levels: Sequence[Names], output: str) -> DataFrame:
    """Per block, how many rows of its group come before it."""
    spot = [*keys, *[name for level in levels for name in level]]
    blocks = df.groupBy(*spot).agg(F.count(F.lit(1)).alias(output))
    return carry(blocks, keys, levels, [output], "sum").fillna(0, [output])


def local_number(spot: Names, seq: Names) -> Column:
    """1, 2, .. within a block."""
    return F.row_number().over(Window.partitionBy(*spot).orderBy(*seq))


def number_rows(
    df: DataFrame, keys: Names, levels: Sequence[Names], seq: Names, output: str
) -> DataFrame:
    """1, 2, .. within ``keys`` in order of levels and seq."""
    spot = [*keys, *[name for level in levels for name in level]]
    offsets = row_offsets(df, keys, levels, "_offset")
    return (
        df.withColumn(output, local_number(spot, seq))
        .join(offsets, spot)
        .withColumn(output, F.col(output) + F.col("_offset"))
        .drop("_offset")
    )
