"""Validation of standardised items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caderneta.functions.text import strip

REQUIRED = ("produto", "data_emissao", "numero_documento", "valor_total_venda")

# The messages a report may hold.
ABSENT = "Campo obrigatório ausente: "
EMPTY = "Campo obrigatório vazio: "
DUPLICATED = "Duplicatas encontradas em id_venda"


def _is_missing(items: DataFrame, name: str) -> Column:
    """Null, NaN or blank; zero is a value."""
    column = F.col(name)
    kind = items.schema[name].dataType.typeName()
    if kind in ("double", "float"):
        return column.isNull() | F.isnan(column)
    if kind == "string":
        return F.coalesce(strip(column) == "", F.lit(True))
    return column.isNull()


def _findings(items: DataFrame) -> DataFrame:
    """One row: total lines and a flag per check, in one pass over the items.

    Items collapse to one row per sale id first, which map tasks do before the
    shuffle, so a sale id of any size costs one row per task.
    """
    fields = [name for name in REQUIRED if name in items.columns]
    flags = [F.bool_or(_is_missing(items, name)).alias(name) for name in fields]
    has_id = "id_venda" in items.columns
    rows = F.count(F.lit(1)).alias("linhas")
    per_id = items.groupBy(F.col("id_venda").alias("id")) if has_id else items.groupBy()
    folded = [F.coalesce(F.bool_or(F.col(name)), F.lit(False)).alias(name) for name in fields]
    repeated = F.bool_or(F.col("linhas") > 1) if has_id else F.lit(False)
    return per_id.agg(rows, *flags).agg(
        F.coalesce(F.sum("linhas"), F.lit(0)).alias("linhas"),
        *folded,
        F.coalesce(repeated, F.lit(False)).alias("repetido"),
    )


def required_violations(items: DataFrame) -> DataFrame:
    """(campo, vazios): how many items miss each required field."""
    fields = [name for name in REQUIRED if name in items.columns]
    counts = items.agg(
        *[F.count_if(_is_missing(items, name)).alias(name) for name in fields]
    )
    pairs = [F.struct(F.lit(n).alias("campo"), F.col(n).alias("vazios")) for n in fields]
    return counts.select(F.inline(F.array(*pairs)))


def duplicate_ids(items: DataFrame) -> DataFrame:
    """Sale ids that occur more than once; a null id counts as one value."""
    return (
        items.groupBy("id_venda")
        .agg(F.count(F.lit(1)).alias("ocorrencias"))
        .filter("ocorrencias > 1")
    )


def with_reasons(items: DataFrame) -> DataFrame:
    """Adds ``motivos``, why each item fails: the messages of ``validate`` that hold for it.

    An item without findings has an empty array.  Of a repeated sale id every row is marked;
    a null id counts as one value.  Ids are counted in map tasks first, and rows meet only
    the ids that repeat; adaptive execution splits the rows of a hot id, which stand on the
    side of that join that may be cut.
    """
    missing = [
        F.when(_is_missing(items, name), EMPTY + name) if name in items.columns
        else F.lit(ABSENT + name)
        for name in REQUIRED
    ]
    if "id_venda" not in items.columns:
        return items.withColumn("motivos", F.array_compact(F.array(*missing)))
    repeated = duplicate_ids(items).select(
        F.col("id_venda").alias("_id"), F.lit(True).alias("_repetido")
    )
    joined = items.join(repeated, F.col("id_venda").eqNullSafe(F.col("_id")), "left")
    twice = F.when(F.col("_repetido"), DUPLICATED)
    return joined.withColumn("motivos", F.array_compact(F.array(*missing, twice))).drop(
        "_id", "_repetido"
    )


def validate(items: DataFrame) -> DataFrame:
    """One row: total_rows, has_errors, total_errors, errors, summary."""
    checks = []
    for name in REQUIRED:
        if name in items.columns:
            checks.append(F.when(F.col(name), EMPTY + name))
        else:
            checks.append(F.lit(ABSENT + name))
    checks.append(F.when(F.col("repetido"), DUPLICATED))
    errors = F.array_compact(F.array(*checks))
    total, rows = F.size("errors"), F.col("linhas").cast("string")
    failed = F.concat(
        total.cast("string"), F.lit(" erro(s) em "), rows, F.lit(" linhas: "),
        F.concat_ws("; ", "errors"),
    )
    passed = F.concat(F.lit("OK - "), rows, F.lit(" linhas, 0 erros"))
    return _findings(items).withColumn("errors", errors).select(
        F.col("linhas").alias("total_rows"),
        (total > 0).alias("has_errors"),
        total.alias("total_errors"),
        "errors",
        F.when(total > 0, failed).otherwise(passed).alias("summary"),
    )


def validation_errors(items: DataFrame) -> DataFrame:
    """The messages of ``validate``, one a row: (ord, error)."""
    return validate(items).select(F.posexplode("errors").alias("ord", "error"))
