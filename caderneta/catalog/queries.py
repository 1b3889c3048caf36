"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caderneta.catalog import tables
from caderneta.functions.dates import br_date_parts, serial_to_date
from caderneta.functions.numbers import br_number
from caderneta.functions.text import (
    document_type,
    product_code,
    product_description,
    strip_accents,
    truncate,
)
from caderneta.operators import calendar, kpis, quality
from caderneta.operators import report_fixed as fixed
from caderneta.operators import report_grid as grid
from caderneta.operators.consolidate import (
    consolidate,
    consolidate_counted,
    consolidation_report,
)
from caderneta.operators.distinct import distinct_in_ranges, month_bitmaps
from caderneta.operators.standardize import standardize
from caderneta.plans import months
from caderneta.plans.audit import audit_summary
from caderneta.plans.incremental import ingest_new, ingest_stream
from caderneta.plans.pipeline import run_items, run_pipeline
from caderneta.schemas import ITEM
from caderneta.scratch import release, work_dir, written
from caderneta.sinks.files import (
    bi_csv_lines,
    export_bi_csv,
    export_csv,
    export_parquet,
    export_quarantine,
    json_lines,
    read_bi_csv,
    read_csv,
)
from caderneta.sinks.report import kpi_report_lines
from caderneta.sources.grid import ingest_grid, layout_name, parse_grid, rows_per_source
from caderneta.sources.report_text import read_purchases, read_report_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The test tables hold 1995 to 2001; the default cut-off would leave one class.
SCOPE_YEAR = 1998


def query(name: str) -> Callable[[Query], Query]:
    """Registers a query, its result in types both engines share."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _portable(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def _portable(df: DataFrame) -> DataFrame:
    casts = {T.DateType: "string", T.IntegerType: "bigint", T.ShortType: "bigint"}
    changed: dict[str, Column] = {}
    for f in df.schema.fields:
        if type(f.dataType) in casts:
            changed[f.name] = F.col(f.name).cast(casts[type(f.dataType)])
    return df.withColumns(changed) if changed else df


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(tables.sales_items(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(consolidate(tables.sales_items(spark, sf_dir)))


# --- sources -----------------------------------------------------------------


def _printed(spark, lines, compression="none"):
    """Lines as latin-1 text files, in their order within a task."""
    path = work_dir(spark, "linhas")
    verbatim = {
        "sep": "\u0001", "quote": "", "escape": "", "emptyValue": "",
        "encoding": "ISO-8859-1", "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false", "compression": compression, "zlib.compress.level": "BEST_SPEED",
    }
    lines.select("line").write.mode("overwrite").options(**verbatim).csv(path)
    return path


@query("rel_line_scan")
def _rel_line_scan(spark, sf_dir):
    """Printed lines written as latin-1 text and scanned back."""
    path = _printed(spark, tables.analytic_lines(spark, sf_dir))
    return fixed.data_lines(read_report_lines(spark, path, glob="*.csv"), fixed.ANALYTIC).select(
        "line"
    )


@query("rel_file_purchases")
def _rel_file_purchases(spark, sf_dir):
    """Text files to purchase items: each document whole in one file, in line order.

    Which documents share a file is up to the write, so what hangs on a file's range of
    numbers is left out.  The lines are compressed: as text they take more disk than all else.
    """
    lines = tables.purchase_lines(spark, sf_dir)
    whole = lines.repartition(fixed.PURCHASE.text("ci")).sortWithinPartitions(
        "arquivo_origem", "blk", "seq"
    )
    items = read_purchases(spark, _printed(spark, whole, "gzip"), glob="*.csv.gz")
    return items.drop("arquivo_origem", "ano_inferido", "confianca", "data_emissao")


@query("rows_per_source")
def _rows_per_source_file(spark, sf_dir):
    names = ("lineitem", "orders", "part", "supplier")
    counts = [rows_per_source(spark, f"{sf_dir}/{n}.parquet") for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query("ingest_union")
def _ingest_union(spark, sf_dir):
    both = tables.hierarchical_grid(spark, sf_dir).unionByName(tables.flat_grid(spark, sf_dir))
    return ingest_grid(both).select(*ITEM.fieldNames())


def _put_workbooks(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Grid files in which workbooks stand whole: one file each, or so many files in all.

    One task writes a file, so workbooks are dealt out evenly by their names; row groups are
    small, so that many tasks can read it.
    """
    known = rows.select("arquivo_origem").distinct().collect()
    names = F.array(*[F.lit(r[0]) for r in sorted(known, key=str) if r[0] is not None])
    number = F.coalesce(F.array_position(names.cast("array<string>"), F.col("arquivo_origem")), F.lit(0))
    count = files or max(1, len(known))
    dealt = rows.repartitionById(count, F.pmod(number, F.lit(count)).cast("int"))
    dealt.write.mode("overwrite").options(**{"compression": "zstd", "parquet.block.size": str(16 << 20)}).parquet(path)
    release(rows.sparkSession)


@query("incremental_ingest")
def _incremental_ingest(spark, sf_dir):
    """Half of the workbooks first, and of the others an old version; then all as they are."""
    both = tables.hierarchical_grid(spark, sf_dir).unionByName(tables.flat_grid(spark, sf_dir))
    odd = F.regexp_extract("arquivo_origem", "([0-9]+)", 1).cast("int") % 2 == 1
    folder, state = work_dir(spark, "pasta"), work_dir(spark, "estado")

    _put_workbooks(both.filter(odd), f"{folder}/a")
    _put_workbooks(both.filter(~odd & (F.col("row_no") <= 500)), f"{folder}/b")
    ingest_new(spark, folder, state)
    _put_workbooks(both.filter(~odd), f"{folder}/b")
    return ingest_new(spark, folder, state).itens.select(*ITEM.fieldNames())


@query("streamed_ingest")
def _streamed_ingest(spark, sf_dir):
    """Four grid files taken in as a stream, two at a time."""
    both = tables.hierarchical_grid(spark, sf_dir).unionByName(tables.flat_grid(spark, sf_dir))
    folder, state = work_dir(spark, "entrada"), work_dir(spark, "estado")
    _put_workbooks(both, folder, files=4)
    done = ingest_stream(spark, folder, state, work_dir(spark, "fluxo"), files=2)
    return done.itens.select(*ITEM.fieldNames())


@query("replaced_months")
def _replaced_months(spark, sf_dir):
    """The stored table after an update with half of the files and one with all of them."""
    items = written(tables.sales_items(spark, sf_dir).select(*ITEM.fieldNames()), "itens")
    table = work_dir(spark, "meses")
    half = F.substring("arquivo_origem", 1, 4).try_cast("int") % 2 == 0
    months.replace_months(items.filter(half), table)
    months.replace_months(items, table)
    return months.stored_months(spark, table).groupBy("mes", "arquivo_origem").agg(
        F.count(F.lit(1)).alias("linhas"), F.round(F.sum("valor_total_venda"), 2).alias("valor")
    )


@query("layout_dispatch")
def _layout_dispatch(spark, sf_dir):
    """Layout chosen per file whatever the case of its suffix."""
    both = tables.hierarchical_grid(spark, sf_dir).unionByName(tables.flat_grid(spark, sf_dir))
    upper = both.withColumn("arquivo_origem", F.upper("arquivo_origem"))
    return (
        parse_grid(upper)
        .groupBy("arquivo_origem", layout_name(F.col("arquivo_origem")).alias("layout"))
        .agg(F.count(F.lit(1)).alias("linhas"))
    )


# --- grids -------------------------------------------------------------------


@query("hier_flatten")
def _hier_flatten(spark, sf_dir):
    return grid.hierarchical_items(tables.hierarchical_grid(spark, sf_dir)).drop("row_no")


@query("hier_filldown")
def _hier_filldown(spark, sf_dir):
    """Items and value under each pair of headings."""
    items = grid.hierarchical_items(tables.hierarchical_grid(spark, sf_dir))
    return items.groupBy("arquivo_origem", "responsavel", "artigo").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.round(F.sum("valor_total_venda"), 2).alias("valor"),
    )


@query("heading_class_counts")
def _heading_class_counts(spark, sf_dir):
    return grid.heading_counts(tables.hierarchical_grid(spark, sf_dir))


@query("flat_grid_extract")
def _flat_grid_extract(spark, sf_dir):
    return grid.flat_items(tables.flat_grid(spark, sf_dir)).drop("row_no")


# --- printed reports ---------------------------------------------------------


@query("rel_synth_filter")
def _rel_synth_filter(spark, sf_dir):
    """Lines left per file once page furniture is gone."""
    kept = fixed.data_lines(tables.synthetic_lines(spark, sf_dir), fixed.SYNTHETIC)
    return kept.groupBy("arquivo_origem").agg(F.count(F.lit(1)).alias("linhas"))


@query("rel_synth_items")
def _rel_synth_items(spark, sf_dir):
    return fixed.synthetic_sales(tables.synthetic_lines(spark, sf_dir))


def _analytic_documents(spark, sf_dir):
    lines = fixed.document_lines(tables.analytic_lines(spark, sf_dir), fixed.ANALYTIC)
    return lines.filter(F.col("descricao") != "")


@query("rel_sales_items")
def _rel_sales_items(spark, sf_dir):
    return fixed.analytic_sales(tables.analytic_lines(spark, sf_dir))


@query("ci_running_year")
def _ci_running_year(spark, sf_dir):
    """Lines per document, printed year and resolved year."""
    years = fixed.with_running_year(_analytic_documents(spark, sf_dir))
    return years.groupBy("arquivo_origem", "ci", "ano_impresso", "ano").agg(
        F.count(F.lit(1)).alias("linhas")
    )


@query("ci_item_sequence")
def _ci_item_sequence(spark, sf_dir):
    items = fixed.analytic_sales(tables.analytic_lines(spark, sf_dir))
    return items.select("arquivo_origem", "ci", "codigo_item", "protocolo", "valor_total_venda")


def _purchase_documents(spark, sf_dir):
    return fixed.document_lines(tables.purchase_lines(spark, sf_dir), fixed.PURCHASE)


@query("rel_purchase_lines")
def _rel_purchase_lines(spark, sf_dir):
    return _purchase_documents(spark, sf_dir).drop("blk", "seq")


@query("ci_group_stats")
def _ci_group_stats(spark, sf_dir):
    return fixed.document_stats(_purchase_documents(spark, sf_dir))


@query("ci_modal_date")
def _ci_modal_date(spark, sf_dir):
    return fixed.modal_dates(_purchase_documents(spark, sf_dir)).select(
        "arquivo_origem", "ci", "data_original", "freq_data", "total_datas"
    )


@query("ci_year_slices")
def _ci_year_slices(spark, sf_dir):
    groups = _purchase_documents(spark, sf_dir).select("arquivo_origem", "ci").distinct()
    return fixed.with_inferred_year(groups)


@query("date_confidence")
def _date_confidence(spark, sf_dir):
    dates = fixed.document_dates(_purchase_documents(spark, sf_dir))
    return dates.groupBy("arquivo_origem", "ano_inferido", "confianca").agg(
        F.count(F.lit(1)).alias("documentos")
    )


@query("purchase_dates")
def _purchase_dates(spark, sf_dir):
    return fixed.document_dates(_purchase_documents(spark, sf_dir)).select(
        "arquivo_origem", "ci", "ano_inferido", "data_emissao"
    )


@query("rel_purchase_items")
def _rel_purchase_items(spark, sf_dir):
    return fixed.purchases(tables.purchase_lines(spark, sf_dir))


# --- standardise, validate, consolidate --------------------------------------


@query("split_product")
def _split_product(spark, sf_dir):
    """Products with and without a separator, and null ones."""
    lines = tables.line_items(spark, sf_dir)
    part = tables.load(spark, sf_dir, "part")
    key = F.col("l_partkey")
    raw = (
        F.when(key % 7 == 0, F.col("p_name"))
        .when(key % 11 == 0, F.lit(None))
        .otherwise(F.concat_ws(" - ", key.cast("string"), "p_name", "p_brand"))
    )
    rows = lines.join(part, lines.l_partkey == part.p_partkey).select(raw.alias("produto"))
    return rows.groupBy(
        product_code(F.col("produto")).alias("codigo_produto"),
        product_description(F.col("produto")).alias("descricao_produto"),
    ).agg(F.count(F.lit(1)).alias("linhas"))


@query("standardize")
def _standardized(spark, sf_dir):
    return _items(spark, sf_dir)


@query("required_field_violations")
def _required_field_violations(spark, sf_dir):
    return quality.required_violations(_items(spark, sf_dir))


@query("duplicate_sales_ids")
def _duplicate_sales_ids(spark, sf_dir):
    return quality.duplicate_ids(_items(spark, sf_dir))


@query("validation_report")
def _validation_report(spark, sf_dir):
    """The report of the items as they are."""
    return quality.validate(_items(spark, sf_dir)).drop("errors")


@query("validation_missing_column")
def _validation_missing_column(spark, sf_dir):
    """The messages when a required column is not there at all."""
    return quality.validation_errors(_items(spark, sf_dir).drop("numero_documento"))


@query("quarantined_items")
def _quarantined_items(spark, sf_dir):
    """Items and value by what the written folders say of them; some lack a number or a value."""
    document, value = F.col("numero_documento"), F.col("valor_total_venda")
    items = _items(spark, sf_dir).withColumns({
        "numero_documento": F.when(F.col("protocolo") == "3", " ").otherwise(document),
        "valor_total_venda": F.when(F.col("protocolo") == "5", None).otherwise(value),
    })
    path = export_quarantine(items, work_dir(spark, "quarentena"))
    return spark.read.parquet(path).groupBy(
        "situacao", F.concat_ws("; ", "motivos").alias("motivos")
    ).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.round(F.sum("valor_total_venda"), 2).alias("valor"),
    )


@query("consolidate")
def _consolidated(spark, sf_dir):
    return consolidate(_items(spark, sf_dir))


@query("consolidation_report")
def _consolidation_totals(spark, sf_dir):
    return consolidation_report(consolidate_counted(_items(spark, sf_dir)))


# --- KPIs --------------------------------------------------------------------


@query("kpi_global")
def _kpi_global(spark, sf_dir):
    return kpis.kpi_global(_clean(spark, sf_dir))


@query("top_products_value")
def _top_products_value(spark, sf_dir):
    return kpis.top_products(_clean(spark, sf_dir), kpis.VALUE)


@query("top_products_qty")
def _top_products_qty(spark, sf_dir):
    return kpis.top_products(_clean(spark, sf_dir), kpis.QUANTITY)


@query("sales_by_month")
def _sales_by_month(spark, sf_dir):
    return kpis.sales_by_month(_clean(spark, sf_dir))


@query("kpi_bundle")
def _kpi_bundle(spark, sf_dir):
    return kpis.kpi_bundle(_clean(spark, sf_dir))


@query("distinct_by_months")
def _distinct_by_months(spark, sf_dir):
    """Sales and products of each month and of the twelve months it ends, from bitmaps."""
    items = written(
        _clean(spark, sf_dir).select("data_emissao", "id_venda", "codigo_produto"), "itens"
    )
    ends = items.select(F.trunc("data_emissao", "month").alias("dia")).distinct().filter("dia IS NOT NULL")
    ranges = ends.select(
        F.explode(F.array(F.lit(0), F.lit(11))).alias("antes"), "dia"
    ).select(
        F.date_format(F.expr("add_months(dia, -antes)"), "yyyy-MM").alias("inicio"),
        F.date_format("dia", "yyyy-MM").alias("fim"),
    )
    ranges = written(ranges, "periodos")
    counts = [
        distinct_in_ranges(month_bitmaps(items, column), ranges).withColumnRenamed("distintos", name)
        for column, name in (("id_venda", "notas"), ("codigo_produto", "produtos"))
    ]
    return counts[0].join(counts[1], ["inicio", "fim"])


# --- sinks and audit ---------------------------------------------------------


@query("parquet_roundtrip")
def _parquet_roundtrip(spark, sf_dir):
    path = export_parquet(_clean(spark, sf_dir), work_dir(spark, "parquet"))
    return spark.read.parquet(path)


@query("csv_roundtrip")
def _csv_roundtrip(spark, sf_dir):
    """Plain CSV there and back; some texts have breaks, quotes, or are empty or null."""
    unit = (
        F.when(F.col("protocolo") == "1", "a\nb").when(F.col("protocolo") == "2", 'a "b",\r\n')
        .when(F.col("protocolo") == "3", "").when(F.col("protocolo") == "4", F.lit(None))
        .otherwise(F.col("unidade_medida"))
    )
    items = _clean(spark, sf_dir).withColumn("unidade_medida", unit)
    path = export_csv(items, work_dir(spark, "csv"), compression="gzip")
    return read_csv(spark, path, items.schema)


@query("bi_csv_rows")
def _bi_csv_rows(spark, sf_dir):
    """The lines of the file written, header and rows."""
    items = _clean(spark, sf_dir)
    header = bi_csv_lines(items).columns[0]
    lines = spark.read.text(export_bi_csv(items, work_dir(spark, "bi"), compression="gzip"))
    return lines.filter(F.col("value") != header).select(
        F.lit(header).alias("cabecalho"), F.col("value").alias("linha")
    )


@query("bi_csv_roundtrip")
def _bi_csv_roundtrip(spark, sf_dir):
    """BI CSV there and back; some texts have breaks, quotes or odd signs, or are null."""
    unit = (
        F.when(F.col("protocolo") == "1", "a\nb").when(F.col("protocolo") == "2", 'a "b",\n')
        .when(F.col("protocolo") == "3", "\u0001").when(F.col("protocolo") == "4", F.lit(None))
        .otherwise(F.col("unidade_medida"))
    )
    items = _clean(spark, sf_dir).withColumn("unidade_medida", unit)
    path = export_bi_csv(items, work_dir(spark, "bi"), compression="gzip")
    return read_bi_csv(spark, path, items.schema).select("protocolo", "unidade_medida", "quantidade")


@query("json_rows")
def _json_rows(spark, sf_dir):
    return json_lines(_clean(spark, sf_dir))


@query("report_lines")
def _report_lines(spark, sf_dir):
    return kpi_report_lines(kpis.compute_kpis(_clean(spark, sf_dir)))


@query("pipeline_run")
def _pipeline_run(spark, sf_dir):
    """The whole run over all grids: the consolidated table it leaves."""
    both = tables.hierarchical_grid(spark, sf_dir).unionByName(tables.flat_grid(spark, sf_dir))
    return run_pipeline(both, work_dir(spark, "run")).dados


def _audited_run(spark, sf_dir):
    audit = work_dir(spark, "audit")
    run_items(tables.sales_items(spark, sf_dir), work_dir(spark, "run"), audit_path=audit)
    return spark.read.parquet(audit)


@query("stage_metrics")
def _stage_metrics(spark, sf_dir):
    """Stages of a run as its audit table has them."""
    return _audited_run(spark, sf_dir).select("ord", "etapa", "linhas", "removidas")


@query("audit_summary")
def _audit_totals(spark, sf_dir):
    """The summary of a run, from its audit table; its times differ from run to run."""
    summary = audit_summary(_audited_run(spark, sf_dir))
    text = F.regexp_replace("resumo", r", [0-9.,]+s", "")
    return summary.select("n_etapas", "linhas_total", "n_erros", "sucesso", text.alias("resumo"))


# --- scalar functions --------------------------------------------------------


@query("excel_serial_dates")
def _excel_serial_dates(spark, sf_dir):
    """Day serials with a fraction, from the ship dates."""
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1899-12-30").cast("date"))
    serial = days + F.col("l_discount")
    rows = tables.load(spark, sf_dir, "lineitem").select(serial.alias("serial"))
    return rows.groupBy(serial_to_date(F.col("serial")).alias("data")).agg(
        F.count(F.lit(1)).alias("linhas")
    )


@query("doc_type_prefix")
def _doc_type_prefix(spark, sf_dir):
    orders = tables.load(spark, sf_dir, "orders")
    return orders.groupBy(document_type(F.col("o_orderpriority")).alias("tipo")).agg(
        F.count(F.lit(1)).alias("linhas")
    )


@query("strip_accents")
def _accents_removed(spark, sf_dir):
    docs = tables.load(spark, sf_dir, "documents")
    return docs.select("doc_id", strip_accents(F.col("text")).alias("texto"))


@query("truncate_text")
def _text_truncated(spark, sf_dir):
    docs = tables.load(spark, sf_dir, "documents")
    return docs.select("doc_id", truncate(F.col("text")).alias("texto"))


@query("br_number")
def _br_numbers(spark, sf_dir):
    """Printed prices read back, with blank, invalid and negative ones."""
    price = F.col("l_extendedprice")
    key = F.col("l_orderkey")
    text = (
        F.when(key % 19 == 0, "  ")
        .when(key % 17 == 0, "1d")
        .when(key % 13 == 0, F.concat(F.lit(" -"), tables.br_text(price)))
        .when(key % 11 == 0, F.format_string("%.0f.000", "l_quantity"))
        .otherwise(tables.br_text(price))
    )
    lines = tables.line_items(spark, sf_dir)
    return lines.select("l_orderkey", "l_linenumber", br_number(text).alias("valor"))


@query("br_date_parts")
def _br_dates(spark, sf_dir):
    """Printed dates to parts; malformed ones give nulls."""
    key = F.col("o_orderkey")
    text = (
        F.when(key % 19 == 0, "31/12")
        .when(key % 17 == 0, "aa/01/2001")
        .when(key % 13 == 0, F.date_format("o_orderdate", "d/M/yy"))
        .otherwise(F.date_format("o_orderdate", "' 'dd/MM/yy' '"))
    )
    parts = br_date_parts(text)
    orders = tables.load(spark, sf_dir, "orders")
    shown = [F.coalesce(parts[p], F.lit(-1)).alias(p) for p in ("dia", "mes", "aa")]
    return orders.groupBy(*shown).agg(F.count(F.lit(1)).alias("linhas"))


# --- calendar rules ----------------------------------------------------------


@query("sunday_sales")
def _sunday_sales(spark, sf_dir):
    return calendar.sunday_sales(_items(spark, sf_dir))


@query("period_overlaps")
def _period_overlaps(spark, sf_dir):
    return calendar.period_overlaps(_items(spark, sf_dir))


@query("overlapping_files")
def _overlapping_files(spark, sf_dir):
    return calendar.overlapping_files(_items(spark, sf_dir))


@query("supersede_partial")
def _supersede_partial(spark, sf_dir):
    """Partial files go first, then the copies that are left."""
    kept = consolidate(calendar.supersede_partial(_items(spark, sf_dir)))
    return kept.groupBy("arquivo_origem", kpis.month_text(F.col("data_emissao")).alias("mes")).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.round(F.sum("valor_total_venda"), 2).alias("valor"),
    )


@query("period_scope")
def _period_scope(spark, sf_dir):
    marked = calendar.mark_scope(_clean(spark, sf_dir), SCOPE_YEAR)
    return marked.groupBy("sistema_origem").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.round(F.sum("valor_total_venda"), 2).alias("valor"),
    )


@query("seasonality_index")
def _seasonality_index(spark, sf_dir):
    return calendar.seasonality_index(_clean(spark, sf_dir))


@query("reprocess_idempotent")
def _reprocess_idempotent(spark, sf_dir):
    """Consolidating all files twice over leaves what one pass leaves."""
    items = tables.sales_items(spark, sf_dir)
    return standardize(consolidate(items.unionByName(items)))
