"""Calendar rules: Sundays, periods of files, scope and seasonality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caderneta.functions.dates import month_text
from caderneta.functions.numbers import money_mean, skip_nan
from caderneta.operators.ordered import carry, never_null

FILE = "arquivo_origem"
DATE = "data_emissao"
VALUE = "valor_total_venda"


def sunday_sales(items: DataFrame) -> DataFrame:
    """Items dated on a Sunday, when the business is closed, per file."""
    return (
        items.filter(F.dayofweek(DATE) == 1)
        .groupBy(FILE)
        .agg(
            F.count(F.lit(1)).alias("itens_domingo"),
            F.round(F.sum(skip_nan(F.col(VALUE))), 2).alias("valor_domingo"),
        )
    )


def file_periods(items: DataFrame) -> DataFrame:
    """First and last date of each file that has dates."""
    return (
        items.filter(F.col(DATE).isNotNull())
        .groupBy(FILE)
        .agg(F.min(DATE).alias("inicio"), F.max(DATE).alias("fim"))
    )


def period_overlaps(items: DataFrame) -> DataFrame:
    """Per file: its period and how many other files' periods it meets.

    For items as ingested: a file that copies another is gone once consolidated.

    Counted without pairing files: the periods that meet [a, b] are those that start
    by b less those that ended before a.  Both counts are running totals over
    calendar days, of which there are few whatever the number of files.
    """
    periods = file_periods(items)
    marks = periods.selectExpr(
        "inline(array(named_struct('dia', inicio, 'abre', 1, 'fecha', 0),"
        " named_struct('dia', fim, 'abre', 0, 'fecha', 1)))"
    )
    days = (
        marks.groupBy("dia")
        .agg(F.sum("abre").alias("abre"), F.sum("fecha").alias("fecha"))
        .withColumns({"todos": F.lit(0), "ano": F.year("dia")})
    )
    before = carry(days, ["todos"], [["ano"], ["dia"]], ["abre", "fecha"], "sum")
    counts = days.select("dia", F.col("abre").alias("abre_dia")).join(before, "dia")
    started = counts.select(
        F.col("dia").alias("fim"),
        (F.coalesce("abre", F.lit(0)) + F.col("abre_dia")).alias("iniciados"),
    )
    ended = before.select(
        F.col("dia").alias("inicio"), F.coalesce("fecha", F.lit(0)).alias("encerrados")
    )
    return (
        periods.join(started, "fim")
        .join(ended, "inicio")
        .select(
            FILE, "inicio", "fim",
            (F.col("iniciados") - F.col("encerrados") - 1).alias("n_sobrepostos"),
        )
    )


BUCKET_DAYS = 32
SALTS = 8


def overlapping_files(items: DataFrame) -> DataFrame:
    """Every two files whose periods meet, and on how many days.

    For items as ingested, like ``period_overlaps``.  (arquivo_a, arquivo_b) are by name.  A
    period stands in each bucket of 32 days that it touches; two periods are paired in the
    first bucket that both touch, so once.  All files may share a bucket: one side is
    dealt over eight tasks a bucket, which all get the other.
    """
    periods = file_periods(items.withColumn(FILE, never_null(FILE))).withColumns({
        "de": F.floor(F.unix_date("inicio") / BUCKET_DAYS), "ate": F.floor(F.unix_date("fim") / BUCKET_DAYS),
    })
    placed = periods.withColumn("faixa", F.explode(F.sequence("de", "ate")))
    a = placed.withColumn("parte", F.pmod(F.xxhash64(FILE), F.lit(SALTS)).cast("int")).alias("a")
    b = placed.withColumn("parte", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("b")
    begin, end = F.greatest("a.inicio", "b.inicio"), F.least("a.fim", "b.fim")
    met = a.join(
        b,
        (F.col("a.faixa") == F.col("b.faixa")) & (F.col("a.parte") == F.col("b.parte"))
        & (F.col(f"a.{FILE}") < F.col(f"b.{FILE}"))
        & (F.col("a.faixa") == F.greatest("a.de", "b.de")) & (begin <= end),
    )
    return met.select(
        F.col(f"a.{FILE}").alias("arquivo_a"), F.col(f"b.{FILE}").alias("arquivo_b"),
        begin.alias("inicio"), end.alias("fim"), (F.date_diff(end, begin) + 1).cast("long").alias("dias"),
    )


def supersede_partial(items: DataFrame) -> DataFrame:
    """Keep, for each month, only the file that holds most of it.

    For items as ingested: consolidating first would take shared rows from the complete
    file, which would then lose to the partial one.  Consolidate what this leaves.

    The fullest version replaces partial ones and no month is counted twice; equal
    counts go to the name that sorts last.  Undated items stay.  A dated item without a
    file name fails the job.
    """
    named = F.when(F.col(DATE).isNull(), F.col(FILE)).otherwise(never_null(FILE))
    months = items.withColumns({"mes": month_text(F.col(DATE)), FILE: named})
    winners = (
        months.filter(F.col(DATE).isNotNull())
        .groupBy("mes", FILE)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("mes")
        .agg(F.max_by(FILE, F.struct("n", FILE)).alias("vencedor"))
    )
    # One row a month, whatever the number of items.
    ranked = months.join(F.broadcast(winners), "mes", "left")
    return ranked.filter(F.col(DATE).isNull() | (F.col(FILE) == F.col("vencedor"))).drop(
        "mes", "vencedor"
    )


def mark_scope(items: DataFrame, first_year: int = 2023) -> DataFrame:
    """Adds ``sistema_origem``: ANTIGO for undated items and those before the scope."""
    current = F.coalesce(F.year(DATE) >= first_year, F.lit(False))
    return items.withColumn("sistema_origem", F.when(current, "ATUAL").otherwise("ANTIGO"))


def seasonality_index(items: DataFrame) -> DataFrame:
    """Per calendar month: its mean monthly total over the mean of all months."""
    monthly = (
        items.filter(F.col(DATE).isNotNull())
        .groupBy(F.year(DATE).alias("ano"), F.month(DATE).alias("mes"))
        .agg(F.sum(skip_nan(F.col(VALUE))).alias("total"))
    )
    by_month = monthly.groupBy("mes").agg(
        F.sum("total").alias("soma"), F.count("total").alias("meses")
    )
    everything = Window.partitionBy(F.lit(1))  # twelve rows at most
    overall = F.sum("soma").over(everything) / F.sum("meses").over(everything)
    mean = F.col("soma") / F.col("meses")
    return by_month.select(
        "mes",
        money_mean(F.col("soma"), F.col("meses")).alias("media_mensal"),
        F.round(mean / overall, 4).alias("indice"),
    )
