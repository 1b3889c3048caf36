"""KPI report text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caderneta.functions.numbers import grouped_text

TITLE = "Relatório de KPIs"
SHOWN = 10
DESCRIPTION_LENGTH = 60

# The wording of the report.
GLOBAL_HEADER = ("## Métricas Globais", "", "| Métrica | Valor |", "|---------|------:|")
RANKING_COLUMNS = ("| # | Código | Descrição | Total |", "|---|--------|-----------|------:|")
MONTH_COLUMNS = ("| Mês | Total |", "|-----|------:|")
BY_VALUE = "## Top Produtos (por valor)"
BY_QUANTITY = "## Top Produtos (por quantidade)"
BY_MONTH = "## Vendas por Mês"


def _money(value: Column) -> Column:
    return F.concat(F.lit("R$ "), grouped_text(value, 2))


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _texts(*lines: str) -> list[Column]:
    return [F.lit(line) for line in lines]


def _section(table: DataFrame, number: int, header: list[Column], row: Column) -> DataFrame:
    """Lines of a section whose table has a ``pos`` from 1; none when it is empty."""
    lines = F.when(F.col("pos") == 1, F.array(*header, row)).otherwise(F.array(row))
    return table.select(F.col("pos"), F.posexplode(lines).alias("sub", "line")).select(
        F.lit(number).alias("secao"), "pos", "sub", "line"
    )


def _ranked(table: DataFrame, *order: Column) -> DataFrame:
    # Only the small KPI tables come here: ten products, or one row a month.
    everything = Window.partitionBy(F.lit(1)).orderBy(*order)
    return table.withColumn("pos", F.row_number().over(everything))


def kpi_report_lines(kpis: dict[str, DataFrame], title: str = TITLE) -> DataFrame:
    """(ord, line) of the report; rankings and months are left out when empty."""
    scalars = (
        ("Faturamento total", _money(F.col("total_faturamento"))),
        ("Notas fiscais", grouped_text(F.col("qtd_notas_fiscais"), 0)),
        ("Itens vendidos", grouped_text(F.col("total_itens"), 0)),
        ("Ticket médio", _money(F.col("ticket_medio"))),
    )
    *first, last = [_row(F.lit(label), value) for label, value in scalars]
    opening = _texts(f"# {title}", "", *GLOBAL_HEADER) + first
    parts = [_section(kpis["global"].withColumn("pos", F.lit(1)), 0, opening, last)]

    rankings = (
        ("top_produtos_valor", BY_VALUE, _money(F.col("total"))),
        ("top_produtos_qtd", BY_QUANTITY, grouped_text(F.col("total"), 0)),
    )
    for number, (name, heading, total) in enumerate(rankings, 1):
        if name in kpis:
            order = (F.desc("total"), F.col("codigo"), F.col("descricao"))
            table = _ranked(kpis[name], *order).filter(F.col("pos") <= SHOWN)
            row = _row(
                F.col("pos").cast("string"), F.col("codigo"),
                F.substring("descricao", 1, DESCRIPTION_LENGTH), total,
            )
            parts.append(_section(table, number, _texts("", heading, "", *RANKING_COLUMNS), row))
    if "vendas_por_mes" in kpis:
        table = _ranked(kpis["vendas_por_mes"], F.col("mes"))
        row = _row(F.col("mes"), _money(F.col("total")))
        parts.append(_section(table, 3, _texts("", BY_MONTH, "", *MONTH_COLUMNS), row))
    ending = (("secao", 9), ("pos", 1), ("sub", 0), ("line", ""))
    one = kpis["global"].sparkSession.range(1)
    parts.append(one.select(*[F.lit(value).alias(name) for name, value in ending]))

    text = parts[0]
    for part in parts[1:]:
        text = text.unionByName(part)
    order = Window.partitionBy(F.lit(1)).orderBy("secao", "pos", "sub")
    return text.select(F.row_number().over(order).alias("ord"), "line")


def export_markdown(
    kpis: dict[str, DataFrame], path: str, title: str = TITLE, mode: str = "overwrite"
) -> str:
    """Writes the report as one part file of text, in order."""
    lines = kpi_report_lines(kpis, title).coalesce(1).sortWithinPartitions("ord")
    lines.select("line").write.mode(mode).text(path)
    return path
