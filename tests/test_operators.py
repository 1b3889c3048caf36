"""Operators against small brute-force restatements and exact values."""

import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import caderneta.operators.report_fixed as fixed
import caderneta.operators.report_grid as grid
from caderneta.operators.calendar import (
    mark_scope, period_overlaps, seasonality_index, sunday_sales, supersede_partial,
)
from caderneta.operators.consolidate import (
    consolidate, consolidate_counted, consolidation_report,
)
from caderneta.operators.distinct import distinct_in_ranges, month_bitmaps, value_numbers
from caderneta.operators.kpis import (
    compute_kpis, kpi_bundle, kpi_cube, kpi_global, sales_by_month, top_products,
)
from caderneta.operators.ordered import number_rows, running_max
from caderneta.operators.quality import (
    duplicate_ids, required_violations, validate, with_reasons,
)
from caderneta.operators.standardize import standardize
from caderneta.schemas import ITEM, RAW_GRID
from caderneta.sinks.files import export_quarantine
from caderneta.sources.grid import ingest_grid, parse_grid

ITEM_ROW = (
    "0000001 - FERRAMENTA A 150MM", date(2025, 1, 15), "001", "001-100001",
    "20250000000000001", 150.0, 2.0, "UN", "TESTE", "FERRAMENTA A", "q1.xlsx",
)


def item(**changes):
    row = dict(zip(ITEM.fieldNames(), ITEM_ROW))
    row.update(changes)
    return tuple(row[name] for name in ITEM.fieldNames())


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ITEM)


# --- ordered helpers: one hot key, many blocks -------------------------------


def _ordered_rows():
    rng = random.Random(7)
    rows = []
    for i in range(600):
        ci = 5 if i % 3 == 0 else rng.randrange(40)  # a third of all rows in one key
        rows.append((rng.choice("ab"), ci // 8, ci, rng.randrange(6), i, rng.randrange(30)))
    return rows


def test_running_max_over_blocks(spark):
    rows = _ordered_rows()
    df = spark.createDataFrame(rows, "f string, faixa int, ci int, blk int, seq int, v int")
    out = running_max(df, ["f"], [["faixa"], ["ci", "blk"]], "seq", "v", "m")
    got = {r.seq: r.m for r in out.collect()}
    best = {}
    for f, _, ci, blk, seq, v in sorted(rows, key=lambda r: (r[0], r[2], r[3], r[4])):
        best[f] = max(best.get(f, v), v)
        assert got[seq] == best[f]
    assert len(got) == len(rows)


def test_number_rows_over_blocks(spark):
    rows = _ordered_rows()
    df = spark.createDataFrame(rows, "f string, faixa int, ci int, blk int, seq int, v int")
    out = number_rows(df, ["f", "ci"], [["blk"]], ["seq"], "n")
    got = {r.seq: r.n for r in out.collect()}
    seen = Counter()
    for f, _, ci, blk, seq, _ in sorted(rows, key=lambda r: (r[3], r[4])):
        seen[f, ci] += 1
        assert got[seq] == seen[f, ci]


# --- hierarchical grid --------------------------------------------------------

TEXTS = ["Artigo: A", "Artigo: B", "Total: x", "Responsável: Ana", "RESPONSAVEL:Zé",
         "TOTAL: Responsável: Ana", "Produto", "", "0001 - PECA", "0002 - PECA", "total: x",
         "artigo: C"]


def _walk(texts):
    """Row by row restatement: (row, responsible, article) of each item."""
    inside, skip, person, article, found = False, False, "", "", []
    for row, text in enumerate(texts, 1):
        folded = text.lower().replace("á", "a")
        if skip:
            skip = False
            continue
        if text.startswith("Artigo:"):
            article, inside, skip = text[7:].strip(), True, True
        elif folded.startswith("total: responsavel:") or text.startswith("Total:"):
            inside = False
        elif folded.startswith("responsavel:"):
            person = text[12:].strip()
        elif inside and text not in ("", "Produto"):
            found.append((row, person, article))
    return found


@pytest.mark.parametrize("block_rows", [3, 16_384])
def test_hierarchy_equals_row_by_row(spark, monkeypatch, block_rows):
    monkeypatch.setattr(grid, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(grid, "ZONE_BLOCKS", 4)
    rng = random.Random(block_rows)
    rows, expected = [], set()
    for f in range(30):
        texts = rng.choices(TEXTS, weights=[3, 1, 1, 1, 1, 1, 1, 1, 4, 4, 1, 1], k=60)
        name = f"{f}.xlsx"
        rows += [(name, i, [(t or None, None, None, None)]) for i, t in enumerate(texts, 1)]
        expected |= {(name, *found) for found in _walk(texts)}
    got = grid.hierarchical_items(spark.createDataFrame(rows, RAW_GRID)).collect()
    assert len(got) == len(expected)
    assert {(r.arquivo_origem, r.row_no, r.responsavel, r.artigo) for r in got} == expected


@pytest.mark.parametrize("numbers", [(1, 2, 4), (2, 3), (0, 1), (1, 1, 2), (1, 2, 5, 6, 7)])
def test_rows_must_be_dense(spark, monkeypatch, numbers):
    monkeypatch.setattr(grid, "BLOCK_ROWS", 3)
    rows = [("a.xlsx", n, [("Artigo: A", None, None, None)]) for n in numbers]
    with pytest.raises(Exception, match="row_no is not dense"):
        grid.hierarchical_items(spark.createDataFrame(rows, RAW_GRID)).collect()


def test_a_null_file_fails(spark):
    rows = [(None, n, [("Artigo: A", None, None, None)]) for n in (1, 2, 3)]
    with pytest.raises(Exception, match="null in arquivo_origem"):
        grid.hierarchical_items(spark.createDataFrame(rows, RAW_GRID)).collect()
    lines = _lines(spark, [_line("000001", "A", "01/02/03", "7", "1,00")], files=[None])
    with pytest.raises(Exception, match="null in arquivo_origem"):
        fixed.analytic_sales(lines).collect()


def test_sparse_document_numbers_stay_spread(spark):
    """Numbers 70,000 apart: no level of ranges puts all documents in one window."""
    numbers = [10_000_000_000 + 70_000 * k for k in range(2000)]
    parts = Counter(n // fixed.CI_REGION for n in numbers)
    inner = Counter(n // fixed.CI_RANGE for n in numbers)
    assert max(inner.values()) <= 2 and fixed.CI_REGION // fixed.CI_RANGE == 65_536
    rows = [_line(f"{k:06d}", "A", f"01/06/{2 + k // 200:02d}", str(n), "1,00")
            for k, n in enumerate(numbers)]
    got = {r.ci: r.data_emissao.year for r in fixed.analytic_sales(_lines(spark, rows)).collect()}
    assert got == {n: 2002 + k // 200 for k, n in enumerate(numbers)} and parts
    plan = fixed.with_inferred_year(
        spark.createDataFrame([("a", n) for n in numbers], "arquivo_origem string, ci bigint")
    )._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def _cells(product=None, **cells):
    row = [None] * 14
    row[0] = (product, None, None, None) if product else None
    places = {"un": 5, "qt": 6, "dt": 7, "pr": 8, "nf": 9, "vl": 13}
    for name, value in cells.items():
        kinds = (value if isinstance(value, str) else None,
                 float(value) if isinstance(value, (int, float)) else None,
                 value if isinstance(value, date) else None, None)
        row[places[name]] = kinds
    return row


def _workbook(name):
    sale = dict(un="UN", qt=2, dt=date(2025, 1, 15), nf="001-100001", vl=150.0)
    texts = [
        _cells("Responsável: TESTE"), _cells("Artigo: FERRAMENTA A"), _cells("Produto"),
        _cells(" 01 - A ", pr=794925, **sale), _cells("02 - B", pr="794926", **sale),
        _cells("03 - C", pr=" 7 ", **{**sale, "dt": "15/01/2025", "vl": "1,5"}),
        _cells("Total: FERRAMENTA A"), _cells("04 - FORA", **sale),
        _cells("Artigo: PARAFUSO B"), _cells("Produto"), _cells("05 - D", **sale),
        _cells(None, **sale), _cells("06 - E", **sale),
    ]
    return [(name, i, cells) for i, cells in enumerate(texts, 1)]


def test_workbook(spark):
    raw = spark.createDataFrame(_workbook("a.xlsx") + _workbook("b.xlsx"), RAW_GRID)
    rows = ingest_grid(raw).orderBy("arquivo_origem", "row_no").collect()
    assert len(rows) == 10
    first, third = rows[0], rows[2]
    assert (first.produto, first.numero_documento, first.tipo_documento, first.quantidade) == (
        "01 - A", "001-100001", "001", 2.0)
    assert (first.responsavel, first.artigo, first.protocolo) == ("TESTE", "FERRAMENTA A", "794925")
    assert third.data_emissao is None and third.valor_total_venda == 0.0 and third.protocolo == "7"
    assert [r.artigo for r in rows[:5]] == ["FERRAMENTA A"] * 3 + ["PARAFUSO B"] * 2


def test_flat_grid(spark):
    rows = [("x.xls", i, _cells("Mapa", dt=1.0)) for i in range(1, 6)]
    rows += [
        ("x.xls", 6, _cells("Produto", dt=45672.0)),
        ("x.xls", 7, _cells("01 - A", dt=45672.5, pr=794925.0, nf="001-1", vl=9.5, qt=1, un=" PC ")),
        ("x.xls", 8, _cells("02 - B", dt="15/01/2025")),
        ("x.xls", 9, _cells("03 - C", dt=45672.0, nf=12.0)),
        ("notas.txt", 9, _cells("04 - D", dt=45672.0)),
    ]
    raw = spark.createDataFrame(rows, RAW_GRID)
    got = ingest_grid(raw).orderBy("row_no").collect()
    assert [r.produto for r in got] == ["01 - A", "03 - C"]
    assert got[0].data_emissao == date(2025, 1, 15) and got[0].protocolo == "794925"
    assert got[0].responsavel is None and got[0].unidade_medida == "PC"
    assert (got[1].numero_documento, got[1].protocolo, got[1].valor_total_venda) == ("12.0", "", 0.0)
    with pytest.raises(Exception, match="Formato não suportado"):
        parse_grid(raw).collect()


def test_empty_grid(spark):
    empty = ingest_grid(spark.createDataFrame([], RAW_GRID))
    assert set(ITEM.fieldNames()) <= set(empty.columns)
    clean = consolidate(standardize(empty.drop("row_no")))
    assert kpi_global(clean).first() == (0.0, 0, 0, 0.0)
    assert sales_by_month(clean).count() == 0


# --- printed reports ----------------------------------------------------------


def _line(item, text, day, ci, value, total=132):
    line = f"{item:<6}{text:<60}{'7':>5}{'UN':<3}{'':6}{'1,00':>12}{day:>10}{ci:>14}{value:>16}"
    return line[:total]


def _lines(spark, rows, files=None):
    data = [(files[i] if files else "a.rel", i // 4, i, line) for i, line in enumerate(rows)]
    return spark.createDataFrame(data, "arquivo_origem string, blk bigint, seq bigint, line string")


def test_analytic_against_brute_force(spark):
    rng = random.Random(3)
    rows, files = [], []
    for i in range(400):
        ci = 77 if i % 3 == 0 else rng.randrange(60, 100)
        day = rng.choice(["29/02", "31/02", "15/06", "01/12", "30/04"])
        rows.append((f"{i:06d}", f"{day}/{rng.randrange(2, 6) + ci // 20:02d}", ci))
        files.append(rng.choice(["a.rel", "b.rel"]))
    lines = _lines(spark, [_line(i, "PEÇA", d, str(c), "1.234,56") for i, d, c in rows], files)
    expected = set()
    for name in ("a.rel", "b.rel"):
        mine = [r for r, f in zip(rows, files) if f == name]
        year, seen = 0, Counter()
        for code, day, ci in sorted(mine, key=lambda r: r[2]):
            d, m, y = map(int, day.split("/"))
            year = max(year, 2000 + y)
            try:
                when = date(year, m, d)
            except ValueError:
                continue
            seen[ci] += 1
            expected.add((name, code, when, ci, str(seen[ci])))
    got = fixed.analytic_sales(lines).collect()
    assert len(got) == len(expected)
    assert {(r.arquivo_origem, r.codigo_item, r.data_emissao, r.ci, r.protocolo)
            for r in got} == expected
    assert {r.valor_total_venda for r in got} == {1234.56}


def _slices(ci, low, high):
    width = (high - low) / 18
    return 2005 + sum(ci >= low + k * width for k in range(1, 18))


def test_purchases_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        ci = 50 if i % 3 == 0 else rng.randrange(10, 90)
        day = rng.choice(["01/01/19", "29/02/20", "10/10/05", "11/11/12", "31/04/08"])
        rows.append((f"{i:06d}", day, ci))
    lines = _lines(spark, [_line(i, "", d, str(c), "10,00") for i, d, c in rows])
    by_ci = {}
    for code, day, ci in rows:
        by_ci.setdefault(ci, []).append((code, day))
    low, high = min(by_ci), max(by_ci)
    expected = set()
    for ci, members in by_ci.items():
        modal, times = Counter(d for _, d in members).most_common(1)[0]
        year = _slices(ci, low, high)
        d, m, y = map(int, modal.split("/"))
        if modal == "01/01/19":
            trust = "Baixa"
        elif times < len(members) * 0.5:
            trust = "Media"
        else:
            trust = "Alta" if 2000 + y == year else "Media"
        try:
            when = date(year, 1, 1) if trust == "Baixa" else date(year, m, d)
        except ValueError:
            when = date(year, 1, 1)
        for n, (code, _) in enumerate(members, 1):
            expected.add((code, ci, when, year, trust, modal, str(n)))
    got = fixed.purchases(lines).collect()
    assert len(got) == len(rows)
    assert {(r.codigo_item, r.ci, r.data_emissao, r.ano_inferido, r.confianca, r.data_original,
             r.protocolo) for r in got} == expected


def test_a_mode_spread_over_blocks(spark):
    """Ties go to the date seen first: lower block, then lower place in it; lines only hash."""
    rows = [("f", 7, 2, 1, 1, 1, 10), ("f", 7, 1, 9, 2, 2, 11), ("f", 7, 1, 3, 3, 3, 12),
            ("f", 7, 2, 5, 2, 2, 11), ("f", 7, 2, 9, 3, 3, 12), ("f", 8, 4, 0, 9, 9, 9)]
    documents = spark.createDataFrame(
        rows, "arquivo_origem string, ci long, blk long, seq long, dia int, mes int, aa int")
    plan = fixed.block_dates(documents)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort " not in plan
    got = {r.ci: (r.data_original, r.freq_data, r.total_datas) for r in fixed.modal_dates(documents).collect()}
    assert got == {7: ("03/03/12", 2, 5), 8: ("09/09/09", 1, 1)}


def test_modes_of_lines_fold_in_hash_tables(spark):
    """Dates of lines are hashed, the few left are sorted by the number; blocks give the same."""
    rows = [("f", 7, None, 8, 4, 4, 10), ("f", 7, 1 << 40, 1, 5, 5, 11), ("f", 7, 1, 1 << 60, 6, 6, 12),
            ("g", 7, (1 << 40) + 1, 0, 5, 5, 11), ("g", 7, 1 << 40, 1 << 62, 6, 6, 12)]
    documents = spark.createDataFrame(
        rows, "arquivo_origem string, ci long, blk long, seq long, dia int, mes int, aa int")
    modes = fixed.modal_dates(documents)
    plan = modes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Sort [arquivo_origem" not in plan
    found = modes.collect()
    assert {(r.arquivo_origem, r.data_original, r.total_datas) for r in found} == {
        ("f", "04/04/10", 3), ("g", "06/06/12", 2)}
    assert sorted(found) == sorted(fixed._modes(fixed.block_dates(documents)).collect())


def test_deciding_texts_are_cut_once(spark):
    lines = spark.createDataFrame([], "arquivo_origem string, blk long, seq long, line string")
    documents = fixed.document_lines(lines, fixed.PURCHASE).select("ci", "dia", "mes", "aa")
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    for name in ("item", "data", "ci"):
        start, end = fixed.PURCHASE.fields[name]
        assert len(re.findall(rf"substring\(line#\d+, {start + 1}, {end - start}\)", plan)) == 1


def test_year_slices_on_edges(spark):
    cases = []
    for low, span in [(10, n) for n in range(18, 400, 3)] + [(10005, 24059), (7, 10**9 + 7)]:
        edges = {low + k * span // 18 + d for k in range(1, 18) for d in (-1, 0, 1)}
        cases += [(low, low + span, ci) for ci in sorted({low, low + span} | edges)]
    rows = [(f"{lo}-{hi}", ci) for lo, hi, ci in cases]
    df = spark.createDataFrame(rows, "arquivo_origem string, ci bigint")
    got = {(r.arquivo_origem, r.ci): r.ano_inferido for r in fixed.with_inferred_year(df).collect()}
    for lo, hi, ci in cases:
        assert got[f"{lo}-{hi}", ci] == _slices(ci, lo, hi)
    one = spark.createDataFrame([("a", 10005)], "arquivo_origem string, ci bigint")
    assert fixed.with_inferred_year(one).first().ano_inferido == 2022


def test_lines_that_are_lost(spark):
    good = _line("000001", "PARAFUSO", "01/02/02", "10", "1,00")
    bad = [
        _line("000001", "SISTEMA HIDRAULICO", "01/02/02", "10", "1,00"),
        _line("00A001", "PARAFUSO", "01/02/02", "10", "1,00"),
        _line("000001", "PARAFUSO", "01/02", "10", "1,00"),
        _line("000001", "PARAFUSO", "01/02/02", "1x", "1,00"),
        _line("000001", "", "01/02/02", "10", "1,00"),
        good[:131], "=" * 132, "-" * 132, " " * 132, "    Total".ljust(132),
    ]
    lines = _lines(spark, [good, *bad])
    assert [r.descricao for r in fixed.analytic_sales(lines).collect()] == ["PARAFUSO"]
    assert fixed.document_lines(lines, fixed.PURCHASE).count() == 2  # blank description stays


def test_synthetic(spark):
    line = (f"{'000123':<6}{'VÁLVULA 3/4':<48}{'12':>9}{'UN':<4}{'1.000,50':>17}{'10,00':>13}"
            f"{'20,00':>13}{'15,00':>12}{'64,29%':>10}")
    dashed = line[:6] + "- nada".ljust(48) + line[54:]
    rows = fixed.synthetic_sales(_lines(spark, [line, dashed])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.produto, r.quantidade, r.qtd_estoque, r.total_custo, r.valor_total_venda,
            r.total_liquido, r.margem_pct) == (
        "000123 - VÁLVULA 3/4", 1000.5, 12.0, 10.0, 20.0, 15.0, 64.29)
    assert r.data_emissao is None and r.numero_documento == ""


# --- standardise, validate, consolidate ----------------------------------------


def test_standardize(spark):
    rows = standardize(items(spark, item(), item(data_emissao=None), item(produto="SEM"))).collect()
    assert rows[0].id_venda == "001001-1000012025-01-15"
    assert rows[0].id_item_venda == "001001-1000012025-01-1520250000000000001"
    assert (rows[0].codigo_produto, rows[0].descricao_produto) == ("0000001", "FERRAMENTA A 150MM")
    assert rows[1].id_venda == "001001-100001None"
    assert (rows[2].codigo_produto, rows[2].descricao_produto) == ("", "SEM")


def test_validate(spark):
    other = item(numero_documento="001-2")
    ok = validate(standardize(items(spark, item(), other))).first()
    assert not ok.has_errors and ok.summary == "OK - 2 linhas, 0 erros"
    fine = items(spark, item(valor_total_venda=0.0, protocolo=""))
    assert not validate(standardize(fine)).first().has_errors
    for change, message in (
        ({"data_emissao": None}, "Campo obrigatório vazio: data_emissao"),
        ({"produto": " \t"}, "Campo obrigatório vazio: produto"),
        ({"numero_documento": ""}, "Campo obrigatório vazio: numero_documento"),
        ({"valor_total_venda": float("nan")}, "Campo obrigatório vazio: valor_total_venda"),
        ({"valor_total_venda": None}, "Campo obrigatório vazio: valor_total_venda"),
    ):
        got = validate(standardize(items(spark, item(**change), other))).first()
        assert got.errors == [message]
    twice = standardize(items(spark, item(), item(protocolo="2")))
    got = validate(twice).first()
    assert got.summary == "1 erro(s) em 2 linhas: Duplicatas encontradas em id_venda"
    assert duplicate_ids(twice).first() == ("001001-1000012025-01-15", 2)
    absent = validate(standardize(items(spark, item())).drop("produto")).first()
    assert absent.errors == ["Campo obrigatório ausente: produto"]
    no_rows = validate(standardize(items(spark))).first()
    assert (no_rows.total_rows, no_rows.has_errors) == (0, False)
    counts = {r.campo: r.vazios for r in
              required_violations(standardize(items(spark, item(produto=None), other))).collect()}
    assert counts == {"produto": 1, "data_emissao": 0, "numero_documento": 0,
                      "valor_total_venda": 0}


def test_quarantine_against_row_by_row(spark, tmp_path):
    """Each row once, in its folder, with the reasons that hold for it; a hot id included."""
    rng = random.Random(8)
    rows = [item(protocolo=str(k), numero_documento=rng.choice(["001-1", "", None, f"001-{k + 9}"]),
                 produto=rng.choice(["A - B", " \t", None]),
                 valor_total_venda=rng.choice([1.0, 0.0, None, float("nan")])) for k in range(90)]
    rows += [item(protocolo=f"h{k}", data_emissao=None) for k in range(60)]
    df = standardize(items(spark, *rows))
    expected, ids = {}, Counter(r.id_venda for r in df.collect())
    for r in df.collect():
        checks = [(not (r.produto or "").strip(), "vazio: produto"),
                  (r.data_emissao is None, "vazio: data_emissao"),
                  (not (r.numero_documento or "").strip(), "vazio: numero_documento"),
                  (r.valor_total_venda is None or r.valor_total_venda != r.valor_total_venda,
                   "vazio: valor_total_venda")]
        found = ["Campo obrigatório " + text for wrong, text in checks if wrong]
        found += ["Duplicatas encontradas em id_venda"] * (ids[r.id_venda] > 1)
        expected[r.protocolo] = ("rejeitado" if found else "aceito", found)
    path = export_quarantine(df, str(tmp_path / "q"))
    got = spark.read.parquet(path).collect()
    assert len(got) == len(rows) and {s for s, _ in expected.values()} == {"aceito", "rejeitado"}
    assert {r.protocolo: (r.situacao, r.motivos) for r in got} == expected
    absent = with_reasons(df.drop("produto", "id_venda")).first()
    assert absent.motivos[0] == "Campo obrigatório ausente: produto"
    assert with_reasons(df.filter("false")).count() == 0


def test_consolidate(spark):
    a, b = item(), item(protocolo="2")
    copy = item(arquivo_origem="q2.xlsx")
    rows = consolidate(standardize(items(spark, copy, a, b))).collect()
    assert sorted((r.protocolo, r.arquivo_origem) for r in rows) == [
        ("2", "q1.xlsx"), ("20250000000000001", "q1.xlsx")]
    more = consolidate_counted(standardize(items(spark, a, a, b, copy)))
    assert consolidation_report(more).first() == (4, 2, 2)
    changed = item(arquivo_origem="q2.xlsx", valor_total_venda=1.0)
    assert consolidate(standardize(items(spark, a, changed))).count() == 2
    nulls = [item(data_emissao=None, responsavel=None, arquivo_origem=f) for f in ("b.xls", "z.xlsx")]
    kept = consolidate(items(spark, *nulls)).collect()
    assert [r.arquivo_origem for r in kept] == ["z.xlsx"]  # .xlsx files are read first
    nan = [item(valor_total_venda=float("nan"))] * 2
    assert consolidate(items(spark, *nan)).count() == 1
    report = consolidation_report(consolidate_counted(items(spark))).first()
    assert report == (0, 0, 0)


def test_consolidate_keeps_first_position(spark):
    rows = [(*item(), 9), (*item(), 4), (*item(arquivo_origem="a.xlsx"), 7)]
    df = spark.createDataFrame(rows, ITEM.fieldNames() + ["row_no"])
    kept = consolidate(df, ["row_no"]).collect()
    assert [(r.arquivo_origem, r.row_no) for r in kept] == [("a.xlsx", 7)]


# --- KPIs and calendar ----------------------------------------------------------

KPI_ROWS = [
    ("0000001", "FERRAMENTA A", "001001-1000012025-01-15", date(2025, 1, 15), 150.0, 2.0),
    ("0000002", "FERRAMENTA B", "001001-1000012025-01-15", date(2025, 1, 15), 300.0, 1.0),
    ("0000003", "PARAFUSO C", "001001-1000022025-03-01", date(2025, 3, 1), 45.0, 10.0),
]
KPI_SCHEMA = ("codigo_produto string, descricao_produto string, id_venda string, "
              "data_emissao date, valor_total_venda double, quantidade double")


def test_kpis(spark):
    df = spark.createDataFrame(KPI_ROWS, KPI_SCHEMA)
    kpis = compute_kpis(df)
    assert kpis["global"].first() == (495.0, 2, 3, 247.5)
    assert kpis["top_produtos_valor"].first() == ("0000002", "FERRAMENTA B", 300.0)
    assert kpis["top_produtos_qtd"].first() == ("0000003", "PARAFUSO C", 10.0)
    assert [tuple(r) for r in kpis["vendas_por_mes"].collect()] == [
        ("2025-01", 450.0), ("2025-03", 45.0)]
    assert top_products(df, top_n=2).count() == 2


def test_kpis_skip_missing(spark):
    rows = KPI_ROWS + [("9", "X", None, None, float("nan"), None)]
    kpis = compute_kpis(spark.createDataFrame(rows, KPI_SCHEMA))
    assert kpis["global"].first() == (495.0, 2, 4, 247.5)
    assert kpis["vendas_por_mes"].collect()[-1] == ("NaT", 0.0)


def test_kpis_read_the_items_once(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"{rng.randrange(9)}", rng.choice(["X", None]), rng.choice([f"id{rng.randrange(50)}", None]),
             date(2025, rng.randrange(1, 5), 1) if rng.random() < 0.9 else None,
             rng.choice([1.25, None, float("nan"), -3.0]), float(rng.randrange(5))) for _ in range(400)]
    path = str(tmp_path / "items")
    spark.createDataFrame(rows, KPI_SCHEMA).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = kpi_cube(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan
    assert not any(path in name for name in kpi_bundle(stored).inputFiles())
    kpis = compute_kpis(stored)
    assert kpis["global"].collect() == kpi_global(stored).collect()
    assert kpis["vendas_por_mes"].collect() == sales_by_month(stored).collect()
    for name, measure in (("top_produtos_valor", "valor_total_venda"), ("top_produtos_qtd", "quantidade")):
        assert kpis[name].collect() == top_products(stored, measure).collect()
    empty = compute_kpis(stored.filter("false"))
    assert empty["global"].first() == (0.0, 0, 0, 0.0)
    assert all(empty[name].count() == 0 for name in list(empty)[1:])


@pytest.mark.parametrize("part_values", [1 << 20, 40])
def test_distinct_counts_of_ranges(spark, monkeypatch, part_values):
    monkeypatch.setattr("caderneta.operators.distinct.PART_VALUES", part_values)
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        value = "hot" if i % 3 == 0 else rng.choice([f"v{rng.randrange(400)}", None, "", "é"])
        day = date(2024 + rng.randrange(2), rng.randrange(1, 13), rng.randrange(1, 29))
        rows.append((value, day if rng.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "v string, data_emissao date")
    numbers = value_numbers(df, "v").collect()
    assert len({(r.parte, r.numero) for r in numbers}) == len(numbers) == len({v for v, _ in rows} - {None})
    assert (len({r.parte for r in numbers}) > 1) == (part_values == 40)
    asked = [("2024-01", "2024-01"), ("2024-03", "2025-02"), ("2024-01", "2025-12"), ("2030-01", "2030-02"),
             ("2024-05", "2024-04"), ("2024-01", "2024-01")]
    ranges = spark.createDataFrame(asked, "inicio string, fim string")
    bitmaps = month_bitmaps(df, "v")
    got = {(r.inicio, r.fim): r.distintos for r in distinct_in_ranges(bitmaps, ranges).collect()}
    assert got == {
        (a, b): len({v for v, d in rows if v is not None and d and a <= d.strftime("%Y-%m") <= b})
        for a, b in asked
    }
    undated = bitmaps.filter("mes = 'NaT'").agg(F.sum(F.bitmap_count("bits"))).first()[0]
    assert undated == len({v for v, d in rows if v is not None and d is None})
    assert month_bitmaps(df.filter("false"), "v").count() == 0


def test_period_overlaps_against_pairs(spark):
    rng = random.Random(5)
    start, rows, spans = date(2024, 12, 1), [], {}
    for f in range(25):
        a, b = sorted((rng.randrange(70), rng.randrange(70)))
        spans[f"{f}.xlsx"] = (start + timedelta(a), start + timedelta(b))
        rows += [item(arquivo_origem=f"{f}.xlsx", data_emissao=d) for d in spans[f"{f}.xlsx"]]
    got = {r.arquivo_origem: (r.inicio, r.fim, r.n_sobrepostos)
           for r in period_overlaps(items(spark, *rows)).collect()}
    for f, (a, b) in spans.items():
        n = sum(c <= b and a <= d for g, (c, d) in spans.items() if g != f)
        assert got[f] == (a, b, n)


def test_supersede_scope_sunday(spark):
    jan, feb = date(2025, 1, 5), date(2025, 2, 3)
    rows = items(
        spark, item(data_emissao=jan, arquivo_origem="parcial.xlsx"),
        item(data_emissao=jan, arquivo_origem="total.xlsx"),
        item(data_emissao=jan, protocolo="2", arquivo_origem="total.xlsx"),
        item(data_emissao=feb, arquivo_origem="parcial.xlsx"),
        item(data_emissao=None, arquivo_origem="parcial.xlsx"),
    )
    kept = Counter((r.arquivo_origem, r.data_emissao) for r in supersede_partial(rows).collect())
    assert kept == {("total.xlsx", jan): 2, ("parcial.xlsx", feb): 1, ("parcial.xlsx", None): 1}
    assert {r.arquivo_origem: r.itens_domingo for r in sunday_sales(rows).collect()} == {
        "parcial.xlsx": 1, "total.xlsx": 2}
    many = [item(protocolo=str(k), arquivo_origem="consolidado.xlsx") for k in range(10)]
    some = [item(protocolo=str(k), arquivo_origem="a_parcial.xlsx") for k in range(5)]
    left = consolidate(supersede_partial(items(spark, *many, *some))).collect()
    assert len(left) == 10 and {r.arquivo_origem for r in left} == {"consolidado.xlsx"}
    twins = items(spark, *[item(arquivo_origem=f) for f in ("a.xlsx", "b.xlsx")])
    assert [r.n_sobrepostos for r in period_overlaps(twins).collect()] == [1, 1]
    scope = Counter(r.sistema_origem for r in mark_scope(rows).collect())
    assert scope == {"ATUAL": 4, "ANTIGO": 1}


def test_seasonality(spark):
    rows = [item(data_emissao=date(y, m, 1), valor_total_venda=v)
            for y, m, v in ((2024, 1, 100.0), (2025, 1, 300.0), (2025, 2, 50.0))]
    got = {r.mes: (r.media_mensal, r.indice) for r in seasonality_index(items(spark, *rows)).collect()}
    assert got == {1: (200.0, 1.3333), 2: (50.0, 0.3333)}
