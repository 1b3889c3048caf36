"""The given star-schema tables as report data.

``sales_items`` maps them to items directly; the ``*_lines`` and ``*_grid`` builders
print the same rows the way the reports do, so that the parsing operators can be
checked against SQL on the source tables.  A printed table is written once per run
and read back: reports are files to the operators, not a plan to optimise through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caderneta.functions.text import document_type
from caderneta.operators.ordered import never_null
from caderneta.schemas import CELL, GRID_CELLS
from caderneta.scratch import put_away, work_dir

LINE_COLUMNS = [
    "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate",
]
UNITS = {"A": "UN", "N": "PC", "R": "KG"}
COPY_FILE = "zz_copy.xlsx"


Table = Callable[[SparkSession, str], DataFrame]
_written: dict[tuple[str, str, str], str] = {}


def stored(build: Table) -> Table:
    """The table as Parquet in the shared work folder, built on first use in a run."""

    @wraps(build)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _written:
            path = work_dir(spark, build.__name__)
            put_away(build(spark, sf_dir), path)
            _written[key] = path
        return spark.read.parquet(_written[key])

    return read


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem")


def sold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its order, part and supplier."""
    joins = (
        ("orders", "l_orderkey", "o_orderkey"),
        ("part", "l_partkey", "p_partkey"),
        ("supplier", "l_suppkey", "s_suppkey"),
    )
    lines = line_items(spark, sf_dir)
    for table, left, right in joins:
        other = load(spark, sf_dir, table)
        lines = lines.join(other, lines[left] == other[right])
    return lines


def _padded(number: Column, width: int = 6) -> Column:
    return F.format_string(f"%0{width}d", number)


def _unit() -> Column:
    unit = F.lit(None).cast("string")
    for flag, name in UNITS.items():
        unit = F.when(F.col("l_returnflag") == flag, name).otherwise(unit)
    return unit


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _product() -> Column:
    return F.concat(_padded(F.col("l_partkey")), F.lit(" - "), "p_name")


def _document() -> Column:
    return F.concat(F.lit("001-"), _padded(F.col("l_orderkey")))


def _issued() -> Column:
    """Issue date; some rows have none."""
    return F.when(~_every("l_orderkey", 97), F.col("o_orderdate").cast("date"))


def sales_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items over yearly files, a tenth of the orders copied into one more file."""
    own = F.concat(F.year("l_shipdate").cast("string"), F.lit(".xlsx"))
    files = F.when(_every("l_orderkey", 10), F.array(own, F.lit(COPY_FILE))).otherwise(F.array(own))
    return sold_lines(spark, sf_dir).select(
        _product().alias("produto"),
        _issued().alias("data_emissao"),
        document_type(_document()).alias("tipo_documento"),
        _document().alias("numero_documento"),
        F.col("l_linenumber").cast("string").alias("protocolo"),
        F.col("l_extendedprice").alias("valor_total_venda"),
        F.col("l_quantity").alias("quantidade"),
        _unit().alias("unidade_medida"),
        F.col("s_name").alias("responsavel"),
        F.col("p_type").alias("artigo"),
        F.explode(files).alias("arquivo_origem"),
    )


# --- printed lines -----------------------------------------------------------

FURNITURE = [
    "=" * 132,
    "01-EMPRESA MODELO".ljust(132),
    "SISTEMA DE GESTAO".ljust(132),
    "Periodo: 01/01/02 a 31/12/22".ljust(132),
    "Mapa Estatistico".ljust(132),
    "Almox..: 01".ljust(132),
    "Item   Artigo".ljust(132),
    "Item  Artigo".ljust(132),
    "    Total".ljust(132),
    "Total Movto".rjust(132),
    "Tipo Movto".rjust(132),
    " " * 132,
    "curta",
]


def br_text(number: Column) -> Column:
    """1234.5 as ``1.234,50``."""
    return F.translate(F.format_number(number, 2), ",.", ".,")


def _left(text: Column, width: int) -> Column:
    return F.rpad(text, width, " ")


def _right(text: Column, width: int) -> Column:
    return F.lpad(text, width, " ")


def _item_code() -> Column:
    return _padded(F.col("l_partkey") % 1_000_000)


def _description() -> Column:
    """Product name with an accent; some are blank, some hold a furniture mark."""
    return (
        F.when(_every("l_orderkey", 101), F.concat("p_name", F.lit(" SISTEMA")))
        .when(_every("l_orderkey", 103), "")
        .otherwise(F.concat("p_name", F.lit(" peça")))
    )


def _printed(rows: DataFrame, line: Column) -> DataFrame:
    """Lines by return flag (one file each), in two runs of document ranges.

    The late items of an order are printed in a second run, so a document is in more
    than one block.  Each fiftieth order is preceded by a page heading.  Rows are ordered
    before they are printed, so that columns and not finished lines are shuffled; equal
    rows print their pages line by line in turn.
    """
    paged = _every("l_orderkey", 50)
    page = F.array(*[F.lit(text) for text in FURNITURE])
    lines = F.when(paged, F.concat(page, F.array(line))).otherwise(F.array(line))
    height = F.when(paged, len(FURNITURE) + 1).otherwise(1)
    # (late, order range, item range) packed in order into one number.
    block = F.expr(
        "((l_linenumber div 6) * 2147483648 + l_orderkey div 4096) * 4096"
        " + l_partkey div 1048576"
    )
    # The number leads the sort key: all file names begin alike.
    within = Window.partitionBy("blk", "arquivo_origem").orderBy(*LINE_COLUMNS)
    equal = within.rangeBetween(Window.currentRow, Window.currentRow)
    so_far = within.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns(
        {"arquivo_origem": F.concat(F.lit("vendas_"), "l_returnflag", F.lit(".rel")), "blk": block}
    ).withColumns(
        {
            "copies": F.count(F.lit(1)).over(equal),
            "copy": F.row_number().over(within) - F.rank().over(within) + 1,
            "until": F.sum(height).over(so_far),
        }
    )
    seq = F.col("until") - F.col("copies") * height + F.col("pos") * F.col("copies") + F.col("copy")
    return placed.select("*", F.posexplode(lines).alias("pos", "line")).select(
        "arquivo_origem", "blk", seq.cast("bigint").alias("seq"), "line"
    )


@stored
def synthetic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report_lines`` of the synthetic layout."""
    lines = line_items(spark, sf_dir)
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    rows = lines.join(part, lines.l_partkey == part.p_partkey)
    price = F.col("l_extendedprice")
    return _printed(
        rows,
        F.concat(
            _item_code(),
            _left(_description(), 48),
            _right((F.col("l_linenumber") * 7).cast("string"), 9),
            _left(_unit(), 4),
            _right(br_text(F.col("l_quantity")), 17),
            _right(br_text(price / 2), 13),
            _right(br_text(price), 13),
            _right(br_text(F.col("l_tax") * 100), 12),
            _right(F.concat(br_text(F.col("p_size") + F.lit(0.25)), F.lit("%")), 10),
        ),
    )


def _document_lines(spark: SparkSession, sf_dir: str, date: Column) -> DataFrame:
    lines = line_items(spark, sf_dir)
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    last = orders.agg(F.max("o_orderkey")).scalar()
    late = _every("l_linenumber", 3)
    rows = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(part, lines.l_partkey == part.p_partkey)
        .withColumn("last_order", last)
        .withColumn("day_source", F.when(late, F.col("l_shipdate")).otherwise(F.col("o_orderdate")))
        .withColumn(
            "yy",
            F.expr("2 + (20 * l_orderkey) div (last_order + 1)") - late.cast("int"),
        )
    )
    return _printed(
        rows,
        F.concat(
            _item_code(),
            _left(_description(), 60),
            _right((F.col("l_linenumber") * 7).cast("string"), 5),
            _left(_unit(), 3),
            F.lit(" " * 6),
            _right(br_text(F.col("l_quantity")), 12),
            _right(date, 10),
            _right((F.col("l_orderkey") + 10005).cast("string"), 14),
            _right(br_text(F.col("l_extendedprice")), 16),
        ),
    )


def _printed_date() -> Column:
    year = _padded(F.col("yy"), 2)
    return F.when(_every("l_orderkey", 89), F.concat(F.lit("31/02/"), year)).otherwise(
        F.concat(F.date_format("day_source", "dd/MM/"), year)
    )


@stored
def analytic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report_lines`` of the analytic layout; printed years sometimes go back."""
    return _document_lines(spark, sf_dir, _printed_date())


@stored
def purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``report_lines`` of the purchase layout; some documents print the sentinel."""
    return _document_lines(
        spark, sf_dir, F.when(_every("l_orderkey", 23), "01/01/19").otherwise(_printed_date())
    )


# --- grids -------------------------------------------------------------------


def _cell(
    s: Column | None = None, n: Column | None = None, d: Column | None = None,
    i: Column | None = None,
) -> Column:
    def part(value: Column | None, kind: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind)

    return F.struct(
        part(s, "string").alias("s"), part(n, "double").alias("n"), part(d, "date").alias("d"),
        part(i, "bigint").alias("i"),
    )


def _cells(**by_name: Column) -> Column:
    width = max(GRID_CELLS.values()) + 1
    empty = F.lit(None).cast(CELL)
    row = [empty] * width
    for name, cell in by_name.items():
        row[GRID_CELLS[name]] = cell
    return F.array(*row)


def _title(text: Column) -> Column:
    return _cells(produto=_cell(s=text))


def _headings(names: Column) -> tuple[Column, Column]:
    """Cells of the heading rows before and after the items of one (file, supplier, type).

    Some blocks have a doubled article heading, some a responsible heading in the
    row an article heading swallows, some a stray row after the total.  A supplier of
    several names has each heading once a name.
    """
    label = (
        F.when(_every("l_suppkey", 3), "Responsável: ")
        .when(F.col("l_suppkey") % 3 == 1, "RESPONSAVEL:")
        .otherwise(" responsável:  ")
    )
    doubled, replaced, stray = (_every("l_suppkey", n) for n in (7, 11, 5))

    def rows(text: Callable[[Column], Column]) -> Column:
        return F.transform(names, lambda row: _title(text(row["s_name"])))

    def of_type(text: str) -> Column:
        return rows(lambda _: F.concat(F.lit(text), "p_type"))

    swallowed = F.when(replaced, "Responsável: IGNORADO").otherwise("Produto")
    before = F.concat(
        rows(lambda name: F.concat(label, name)),
        of_type("Artigo: "),
        F.when(doubled, rows(lambda _: F.lit("Artigo: DUPLO"))).otherwise(_no_rows()),
        rows(lambda _: swallowed),
    )
    after = F.concat(
        of_type("Total: "),
        rows(lambda name: F.concat(F.lit("TOTAL: Responsável: "), name)),
        F.when(stray, rows(lambda _: F.lit("999999 - LINHA SOLTA"))).otherwise(_no_rows()),
    )
    return before, after


def _no_rows() -> Column:
    return F.array().cast(T.ArrayType(T.ArrayType(CELL)))


@stored
def hierarchical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the hierarchical grid, in files in their order: (arquivo_origem, parte, n, cells).

    Lines are put in order by ranges, with their columns alone, and get their headings where
    a (file, supplier, type) begins and ends.  ``n`` rises within a ``parte``, which is a task.
    """
    lines = sold_lines(spark, sf_dir).withColumn(
        "arquivo_origem", F.concat(F.year("l_shipdate").cast("string"), F.lit(".xlsx"))
    )
    group = ["arquivo_origem", "l_suppkey", "p_type"]
    order = [c for c in LINE_COLUMNS if c != "l_suppkey"] + ["l_returnflag"]
    even = _every("l_linenumber", 2)
    number, text = F.col("l_linenumber"), F.col("l_linenumber").cast("string")
    long_number = F.lit(20_250_000_000_000_000) + number
    item = _cells(
        produto=_cell(s=F.concat(F.lit(" "), _product(), F.lit(" "))),
        unidade_medida=_cell(s=_unit()),
        quantidade=_cell(n=F.col("l_quantity")),
        data_emissao=F.when(_every("l_orderkey", 97), F.lit(None).cast(CELL))
        .when(_every("l_orderkey", 89), _cell(s=F.lit("31/02/2001")))
        .otherwise(_cell(d=F.col("o_orderdate"))),
        protocolo=F.when(_every("l_orderkey", 13), _cell(i=long_number))
        .when(even, _cell(n=number)).otherwise(_cell(s=text)),
        numero_documento=_cell(s=_document()),
        valor_total_venda=F.when(_every("l_orderkey", 83), _cell(s=F.lit("1,5"))).otherwise(
            _cell(n=F.col("l_extendedprice"))
        ),
    )
    ordered = Window.partitionBy(*group).orderBy(F.expr("l_orderkey div 4096"), *order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        lines.select(
            *[never_null(c).alias(c) for c in group], *order, "s_name", "p_name", "o_orderdate"
        )
        .repartitionByRange(*group)
        .withColumns(
            {
                "first": F.row_number().over(ordered) == 1,
                "last": F.lead(F.lit(True)).over(ordered).isNull(),
                "names": F.array_sort(F.collect_set(F.struct("s_name")).over(whole)),
            }
        )
    )
    before, after = _headings(F.col("names"))
    rows = F.concat(
        F.when(F.col("first"), before).otherwise(_no_rows()),
        F.array(item),
        F.when(F.col("last"), after).otherwise(_no_rows()),
    )
    # The task stands in the upper bits, the row of the task in the lower 33.
    place = F.monotonically_increasing_id()
    return placed.select("arquivo_origem", F.explode(rows).alias("cells")).select(
        "arquivo_origem", place.alias("place"), "cells"
    ).select(
        "arquivo_origem", F.shiftrightunsigned("place", 33).alias("parte"),
        F.col("place").bitwiseAND((1 << 33) - 1).alias("n"), "cells",
    )


@stored
def hierarchical_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What turns ``n`` into a row number: a row per file and task."""
    counted = hierarchical_rows(spark, sf_dir).groupBy("arquivo_origem", "parte").agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("start")
    )
    earlier = (
        Window.partitionBy("arquivo_origem").orderBy("parte")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    above = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    return counted.select("arquivo_origem", "parte", (above + 1 - F.col("start")).alias("shift"))


def hierarchical_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_grid`` of yearly ``.xlsx`` files: suppliers, then types, then items."""
    rows = hierarchical_rows(spark, sf_dir)
    return rows.join(hierarchical_parts(spark, sf_dir), ["arquivo_origem", "parte"]).select(
        "arquivo_origem", (F.col("n") + F.col("shift")).cast("bigint").alias("row_no"), "cells"
    )


@stored
def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the flat grid without its titles."""
    lines = sold_lines(spark, sf_dir).withColumn(
        "arquivo_origem",
        F.concat(F.lit("legado_"), F.year("l_shipdate").cast("string"), F.lit(".xls")),
    )
    serial = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    item = _cells(
        produto=_cell(s=_product()),
        unidade_medida=_cell(s=_unit()),
        quantidade=_cell(n=F.col("l_quantity")),
        data_emissao=F.when(_every("l_orderkey", 97), F.lit(None).cast(CELL))
        .when(_every("l_orderkey", 89), _cell(s=F.lit("15/01/2001")))
        .otherwise(_cell(n=serial + F.lit(0.75))),
        protocolo=_cell(n=F.col("l_linenumber") + 7_000_000),
        numero_documento=_cell(s=_document()),
        valor_total_venda=_cell(n=F.col("l_extendedprice")),
    )
    return lines.select(
        "arquivo_origem",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber") + 6).alias("row_no"),
        item.alias("cells"),
    )


@stored
def flat_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title rows of each flat file that has rows."""
    titled = _cells(
        produto=_cell(s=F.lit("Mapa")), data_emissao=_cell(n=F.lit(36_000.0)),
    )
    column_title = _cells(
        produto=_cell(s=F.lit("Produto")), data_emissao=_cell(n=F.lit(36_000.0)),
    )
    opening = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("row_no"), cells.alias("cells"))
            for i, cells in enumerate([titled] * 5 + [column_title], 1)
        ]
    )
    files = flat_rows(spark, sf_dir).select("arquivo_origem").distinct()
    return files.select("arquivo_origem", F.inline(opening))


def flat_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_grid`` of yearly ``.xls`` files; only "row 6 or later" matters there."""
    return flat_titles(spark, sf_dir).unionByName(flat_rows(spark, sf_dir))
