"""Exact duplicates across files, first occurrence kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE = "arquivo_origem"
COPIES = "copias"

# Suffixes in the order their files are read.
SUFFIX_ORDER = (".xlsx", ".xls", ".Xls")


def file_order(name: Column) -> Column:
    """Sortable position of a file: by suffix, then by name."""
    rank = F.lit(len(SUFFIX_ORDER))
    for i, suffix in reversed(list(enumerate(SUFFIX_ORDER))):
        rank = F.when(name.endswith(suffix), i).otherwise(rank)
    return F.struct(rank.alias("sufixo"), name.alias("nome"))


def consolidate_counted(items: DataFrame, position: Sequence[str] = ()) -> DataFrame:
    """``consolidate`` plus ``copias``, how many input rows each kept row stands for.

    Copies are equal in every other column, so keeping the first one only decides
    the file name (and ``position``).  That makes it a plain minimum: map tasks fold
    copies together before the shuffle, so a row copied a billion times still
    sends one row per task.
    """
    lineage = [FILE, *position]
    compared = [c for c in items.columns if c not in lineage]
    # The hash leads the sort key: rows are told apart by its 8 bytes instead of by
    # long common prefixes of document and product text.  The columns still decide.
    first = F.struct(file_order(F.col(FILE)).alias("arquivo"), *position)
    kept = items.groupBy(F.xxhash64(*compared).alias("_h"), *compared).agg(
        F.min(first).alias("_first"), F.count(F.lit(1)).alias(COPIES)
    )
    back = {FILE: F.col("_first.arquivo.nome"), **{p: F.col(f"_first.{p}") for p in position}}
    return kept.withColumns(back).select(*items.columns, COPIES)


def consolidate(items: DataFrame, position: Sequence[str] = ()) -> DataFrame:
    """Drop rows equal in all columns but the file; null equals null.

    ``position`` names further lineage columns (such as the row number) that are not
    compared either and are kept from the first occurrence.
    """
    return consolidate_counted(items, position).drop(COPIES)


def consolidation_report(counted: DataFrame) -> DataFrame:
    """One row of totals from a ``consolidate_counted`` result."""
    original = F.coalesce(F.sum(COPIES), F.lit(0))
    final = F.count(F.lit(1))
    return counted.agg(
        original.alias("total_original"),
        final.alias("total_final"),
        (original - final).alias("linhas_removidas"),
    )
