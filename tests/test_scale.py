"""Steps that must not shuffle, sort or gather more than their input: their plans, and their rows."""

import datetime
import os
import re
import time

import pytest

from caderneta.catalog import tables
from caderneta.operators import report_fixed as fixed
from caderneta.operators import report_grid as grid
from caderneta.operators.calendar import supersede_partial
from caderneta.operators.consolidate import consolidate
from caderneta.operators.standardize import standardize
from caderneta.plans import months, pipeline
from caderneta.schemas import ITEM, RAW_GRID
from caderneta.scratch import written
from caderneta.sinks.files import export_bi_csv
from caderneta.sources.grid import ingest_grid
from test_operators import item, items


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Lines that come twice, a document with a page heading, a supplier of two names."""
    day = datetime.datetime(1995, 3, 4)
    lines = [
        (order, part, 7, line, 1.0, 2.0, 0.0, 0.0, "A", "O", day)
        for order, part, line in [(50, 1, 1), (50, 1, 1), (51, 2, 1), (51, 1, 7), (52, 2, 1)]
    ]
    made = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp"),
        "orders": ([(n, day) for n in (50, 51, 52)], "o_orderkey long, o_orderdate timestamp"),
        "part": ([(1, "bolt", "T1", 1), (2, "nut", "T2", 2)], "p_partkey long, p_name string, p_type string, p_size int"),
        "supplier": ([(7, "S"), (7, "Z")], "s_suppkey long, s_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_are_printed_after_they_are_ordered(spark, sf_dir):
    plan = _plan(tables.analytic_lines.__wrapped__(spark, sf_dir))
    assert plan.index("Generate") < plan.index("Window")
    got = {(r.blk, r.seq): r.line for r in tables.analytic_lines(spark, sf_dir).collect()}
    first, late = sorted({blk for blk, _ in got})
    # Two equal rows print each line of the page heading twice in turn, then themselves.
    texts = [got[first, n] for n in range(1, len(got))]
    assert texts[:28:2] == texts[1:28:2] and texts[0] == "=" * 132 and texts[26].startswith("000001bolt")
    assert [t[:6] for t in texts[28:]] == ["000002", "000002"] and (late, 1) in got


def test_number_texts_are_made_once(spark, sf_dir):
    lines = tables.analytic_lines(spark, sf_dir)
    documents = fixed.document_lines(lines, fixed.ANALYTIC)
    assert _plan(documents).count("translate(") == 3
    read = {name: fixed.ANALYTIC.number(field) for name, field in (("quantidade", "quantidade"), ("qtd_estoque", "estoque"), ("valor", "total"))}
    plain = lines.filter("length(trim(line)) > 100").select("blk", "seq", *[number.alias(name) for name, number in read.items()])
    kept = documents.select("blk", "seq", *read)
    assert kept.count() == 5 and kept.exceptAll(plain).count() == 0


def test_the_grid_is_joined_once(spark, sf_dir):
    assert _plan(tables.hierarchical_rows.__wrapped__(spark, sf_dir)).count("Relation [") == 4
    rows = sorted(tables.hierarchical_grid(spark, sf_dir).collect(), key=lambda r: r.row_no)
    assert [r.row_no for r in rows] == list(range(1, len(rows) + 1))
    titles = [r.cells[0].s.strip() for r in rows]

    def block(part, items):
        return [
            "RESPONSAVEL:S", "RESPONSAVEL:Z", f"Artigo: {part}", f"Artigo: {part}", *["Artigo: DUPLO"] * 2,
            *["Produto"] * 2, *items, f"Total: {part}", f"Total: {part}", "TOTAL: Responsável: S", "TOTAL: Responsável: Z",
        ]

    assert titles == block("T1", ["000001 - bolt"] * 6) + block("T2", ["000002 - nut"] * 4)


def _methods(spark, df):
    """Bytes of the largest method of each piece of whole-stage code."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution()
        code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:([0-9]+)", code)]


def test_cells_are_read_by_methods_that_the_jvm_compiles(spark):
    sheet = spark.createDataFrame([("a.xlsx", 1, [("Artigo: A", None, None, None)])], RAW_GRID)
    for items in (grid.hierarchical_items(sheet), grid.flat_items(sheet), ingest_grid(sheet)):
        sizes = _methods(spark, items.drop("row_no"))
        assert sizes and max(sizes) <= 8000


def test_bi_csv_computes_its_items_once(spark, tmp_path):
    looked_at = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            looked_at.add(batch.num_rows)
            yield batch

    shown = spark.range(0, 100, 1, 1).mapInArrow(rows, "id long").repartition(1)
    path = export_bi_csv(shown, f"{tmp_path}/bi")
    assert looked_at.value == 100
    assert spark.read.text(path).count() == 101
    # Nothing is left of the rows before when there are none any more.
    assert [r.value for r in spark.read.text(export_bi_csv(shown.filter("id < 0"), path)).collect()] == ['"id"']
    for mode in ("append", "ignore"):
        more = export_bi_csv(shown.filter("id < 0"), f"{tmp_path}/{mode}", mode=mode)
        assert [r.value for r in spark.read.text(more).collect()] == ['"id"']
    assert spark.read.text(export_bi_csv(shown, path, mode="append")).count() == 102


def test_a_run_keeps_its_items_twice_at_most(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "work_dir", lambda _, purpose: f"{tmp_path}/{purpose}")
    seen = []
    write = pipeline.export_bi_csv

    def written_last(data, path):
        seen.append(os.path.exists(f"{tmp_path}/contadas"))
        return write(data, path)

    monkeypatch.setattr(pipeline, "export_bi_csv", written_last)
    rows = items(spark, item(), item(arquivo_origem="b.xlsx"), item(protocolo="9"))
    assert pipeline.consolidated_items(rows).columns == [*ITEM.fieldNames(), "copias"]
    result = pipeline.run_items(rows, f"{tmp_path}/out")
    assert seen == [False] and not os.path.exists(f"{tmp_path}/contadas")
    assert result.etapas["consolidacao"]["linhas"] == 2 and result.etapas["consolidacao"]["removidas"] == 1
    whole = sorted(map(str, standardize(consolidate(rows)).collect()))
    assert sorted(map(str, result.dados.collect())) == whole
    assert spark.read.text(f"{tmp_path}/out/{pipeline.CSV}").filter("value LIKE '%001-100001%'").count() == 2


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffles_behind_a_working_table_are_deleted(spark):
    before = _shuffles(spark)
    table = written(spark.range(10_000).repartition(7), "teste")
    made = _shuffles(spark) - before
    assert written(table, "teste").count() == 10_000
    end = time.monotonic() + 20
    while _shuffles(spark) & made and time.monotonic() < end:
        time.sleep(0.2)
    assert not _shuffles(spark) & made


def test_an_update_computes_its_items_for_two_readings(spark, tmp_path):
    looked_at = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            looked_at.add(batch.num_rows)
            yield batch

    many = items(spark, *[item(protocolo=str(k)) for k in range(50)]).coalesce(1).mapInArrow(rows, ITEM)
    table = f"{tmp_path}/meses"
    assert months.replace_months(many, table) == ["2025-01"]
    assert looked_at.value == 100  # supersede_partial reads them twice
    # A month's winner is one row: the items are not shuffled to meet it.
    assert "rightHint=(strategy=broadcast)" in _plan(supersede_partial(many))
    assert months.stored_months(spark, table).count() == 50


def test_tasks_grow_with_the_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "BLOCK_ROWS", 3)
    monkeypatch.setattr(grid, "TASK_BLOCKS", 1)
    rows = [("a.xlsx", n, [("Artigo: A" if n == 1 else "x", None, None, None)]) for n in range(1, 60)]
    items = grid.hierarchical_items(spark.createDataFrame(rows, RAW_GRID))
    # 20 blocks; their rows meet no other table on the way.
    assert "RepartitionByExpression" in _plan(items) and ", 20" in _plan(items)
    assert sorted(r.row_no for r in items.collect()) == list(range(3, 60))
