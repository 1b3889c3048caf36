"""Column functions on edge values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from caderneta.functions.cells import cell_date, cell_number, cell_text
from caderneta.functions.dates import (
    br_date_parts, date_text, month_text, serial_to_date, valid_date,
)
from caderneta.functions.numbers import (
    br_number, br_percent, grouped_text, number_text, to_double,
)
from caderneta.functions.text import (
    document_type, is_digits, product_code, product_description, snake_case, strip,
    strip_accents, truncate,
)
from caderneta.schemas import CELL, T


def apply(spark, function, values, kind="string"):
    """The function's value for each input, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_br_number(spark):
    cases = {
        "1.234,56": 1234.56, "12,50": 12.5, "35": 35.0, "-239,96": -239.96, "": 0.0,
        "   1.000,00  ": 1000.0, "1.234": 1234.0, "abc": 0.0, "1d": 0.0, "NaN": 0.0,
        "Infinity": 0.0, "1,2,3": 0.0, ",5": 0.5, "5,": 5.0, "+7": 7.0, "0x1p3": 0.0,
        "\xa012,5\xa0": 12.5, "1e3": 1000.0,
    }
    assert apply(spark, br_number, list(cases)) == list(cases.values())
    assert apply(spark, br_number, [None]) == [0.0]


def test_percent(spark):
    assert apply(spark, br_percent, ["64,29%", " 64,29 ", "12%%", "", "x%"]) == [
        64.29, 64.29, 12.0, 0.0, 0.0]


def test_to_double(spark):
    assert apply(spark, to_double, ["1.5", " 2 ", "1,5", "1f", "", None]) == [
        1.5, 2.0, None, None, None, None]


def test_number_text(spark):
    cases = {150.0: "150.0", 0.1: "0.1", 1e7: "10000000.0", 12345678.9: "12345678.9",
             -23.5: "-23.5", 0.00025: "0.00025", 180700000.25: "180700000.25", 0.0: "0.0"}
    got = apply(spark, lambda _: F.expr(number_text("x")), list(cases), "double")
    assert got == list(cases.values()) == [repr(x) for x in cases]


def test_grouped_text(spark):
    assert apply(spark, lambda c: grouped_text(c, 2), [1234.5, 10000.0], "double") == [
        "1_234.50", "10_000.00"]


def test_br_date_parts(spark):
    got = apply(spark, br_date_parts, [
        "01/02/02", "  01/02/02  ", "", "31/12", "1/2/02", "aa/02/02", "01/02/2002", "01/02/02/3"])
    assert [tuple(r) if r else None for r in got] == [
        (1, 2, 2), (1, 2, 2), None, None, None, None, (1, 2, 2002), None]


def test_valid_date(spark):
    days = spark.createDataFrame(
        [(2021, 2, 31), (2020, 2, 29), (2021, 2, 29), (2021, 13, 1), (4002, 1, 5), (12002, 1, 1),
         (2021, -1, 3), (2021, 0, 3)], "y int, m int, d int")
    got = [r[0] for r in days.select(valid_date(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [None, date(2020, 2, 29), None, None, date(4002, 1, 5), None, None, None]


def test_dates(spark):
    assert apply(spark, serial_to_date, [45672.9, 1.0], "double") == [
        date(2025, 1, 15), date(1899, 12, 31)]
    assert apply(spark, date_text, [date(2025, 1, 15), None], "date") == ["2025-01-15", "None"]
    assert apply(spark, month_text, [date(2025, 1, 15), None], "date") == ["2025-01", "NaT"]


def test_text(spark):
    assert apply(spark, strip, ["\u2003 a b\xa0\t", "\x85x\u3000", " ", None]) == [
        "a b", "x", "", None]
    assert apply(spark, strip_accents, ["Responsável ÇÃO ü"]) == ["Responsavel CAO ü"]
    assert apply(spark, document_type, ["001-100001", "001", "", "a-b-c"]) == ["001", "001", "", "a"]
    assert apply(spark, lambda c: truncate(c, 3), ["abcd", "ab", None]) == ["abc", "ab", ""]
    assert apply(spark, is_digits, ["012", "", "1a", "²"]) == [True, False, False, False]


def test_split_product(spark):
    values = ["0000001 - FERRAMENTA A", "A - B - C", "SEM CODIGO", None, " - X"]
    assert apply(spark, product_code, values) == ["0000001", "A", "", "", ""]
    assert apply(spark, product_description, values) == [
        "FERRAMENTA A", "B - C", "SEM CODIGO", "", "X"]


@pytest.mark.parametrize("name, expected", [
    ("Data Emissão", "data_emissao"), ("valorTotalVenda", "valor_total_venda"),
    ("id-venda", "id_venda"), ("  NF  Número ", "n_f_numero"),
    ("produto", "produto"),
])
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_cells(spark):
    schema = T.StructType([T.StructField("i", T.IntegerType()),
                           T.StructField("cells", T.ArrayType(CELL))])
    rows = [
        (0, [("  x ", None, None, None)]), (1, [(None, 794925.0, None, None)]),
        (2, [(None, 1.5, None, None)]), (3, [(None, None, date(2025, 1, 15), None)]), (4, [None]),
        (5, []), (6, [("1,5", None, None, None)]), (7, [(None, None, None, 20250000000000001)]),
    ]
    df = spark.createDataFrame(rows, schema).orderBy("i").select(
        cell_text(0).alias("t"), cell_text(0, False).alias("r"), cell_number(0).alias("n"),
        cell_date(0).alias("d"))
    got = df.collect()
    assert [r.t for r in got] == ["x", "794925", "1.5", "2025-01-15", "", "", "1,5", "20250000000000001"]
    assert got[1].r == "794925.0" and got[7].r == "20250000000000001.0"
    assert [r.n for r in got] == [0.0, 794925.0, 1.5, 0.0, 0.0, 0.0, 0.0, 20250000000000001.0]
    assert [r.d for r in got] == [None, None, None, date(2025, 1, 15), None, None, None, None]
