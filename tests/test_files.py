"""Readers, writers, pipeline, audit."""

import glob
from collections import Counter
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from caderneta import run_pipeline
from caderneta.operators.kpis import compute_kpis
from caderneta.operators.standardize import standardize
from caderneta.plans.audit import append_audit, audit_summary
from caderneta.schemas import ITEM, RAW_GRID
from caderneta.scratch import work_dir
from caderneta.sinks.files import (
    export_bi_csv, export_csv, export_json, export_parquet, json_lines, read_csv,
)
from caderneta.sinks.report import export_markdown
from caderneta.sources.grid import read_grid
from caderneta.sources.report_text import read_analytic_sales, read_purchases, read_report_lines
from test_operators import KPI_ROWS, KPI_SCHEMA, _line, _workbook, item, items


def part_lines(path):
    parts = sorted(glob.glob(f"{path}/part-*"))
    return [open(p, encoding="utf-8", newline="").read() for p in parts]


def test_latin1_lines_in_order_over_splits(spark, tmp_path):
    lines = [_line(f"{i:06d}", f"AÇÃO\xa0{i}", "01/02/02", str(i // 3), "1,00") for i in range(500)]
    (tmp_path / "a.rel").write_bytes("\r\n".join(["curta", *lines]).encode("latin-1"))
    (tmp_path / "b.rel").write_bytes("\n".join(lines[:10]).encode("latin-1"))
    (tmp_path / "c.txt").write_bytes(b"x" * 140)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        raw = read_report_lines(spark, str(tmp_path))
        assert raw.select("blk").distinct().count() > 5
        first = raw.filter("arquivo_origem LIKE '%/a.rel'").orderBy("blk", "seq")
        assert [r.line for r in first.collect()] == lines
        items_read = read_analytic_sales(spark, str(tmp_path)).filter("arquivo_origem = 'a.rel'")
        got = {r.codigo_item: (r.descricao, r.protocolo) for r in items_read.collect()}
        assert got == {f"{i:06d}": (f"AÇÃO\xa0{i}", str(i % 3 + 1)) for i in range(500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_of_one_name_stay_apart(spark, tmp_path):
    def write(folder, first, year):
        path = tmp_path / folder
        path.mkdir()
        lines = [_line(f"{i:06d}", "A", f"01/02/{year:02d}", str(first + i // 2), "1,00") for i in range(40)]
        (path / "m +á.rel").write_bytes("\n".join(lines).encode("latin-1"))
        return str(path)

    a, b = write("a", 100, 3), write("b", 90, 16)
    for read in (read_analytic_sales, read_purchases):
        alone = [*read(spark, a).collect(), *read(spark, b).collect()]
        assert Counter(map(str, read(spark, a, b).collect())) == Counter(map(str, alone))
        assert {r.arquivo_origem for r in alone} == {"m +á.rel"}


def test_csv_there_and_back(spark, tmp_path):
    texts = ["a\nb", 'q"u"o', "x\r\ny", "", None, " , ", "plain"]
    rows = items(spark, *[item(responsavel=t, protocolo=str(k)) for k, t in enumerate(texts)])
    path = export_csv(rows, str(tmp_path / "csv"))
    back = {r.protocolo: r.responsavel for r in read_csv(spark, path, rows.schema).collect()}
    assert back == {str(k): t for k, t in enumerate(texts)}


def test_bi_csv(spark, tmp_path):
    rows = items(
        spark, item(produto='01 - "A", B' + "x" * 300, valor_total_venda=12345678.5),
        item(data_emissao=None, responsavel=None, quantidade=None),
    ).coalesce(1)
    path = export_bi_csv(rows.withColumnRenamed("artigo", "Artigo Pai"), str(tmp_path / "bi"))
    (text,) = part_lines(path)
    header, first, second = text.rstrip("\n").split("\n")
    assert header.split(",")[:2] == ['"produto"', '"data_emissao"'] and '"artigo_pai"' in header
    product = ('01 - "A", B' + "x" * 300)[:255].replace('"', '""')
    assert first.startswith(f'"{product}","2025-01-15","001","001-100001",')
    assert ",12345678.5,2.0," in first
    assert second.split(",")[1] == '""' and second.split(",")[6] == '""'
    other = export_bi_csv(rows, str(tmp_path / "bi2"), sep=";", date_format="dd/MM/yyyy")
    assert '"15/01/2025";' in part_lines(other)[0]


def test_csv_and_empty_csv(spark, tmp_path):
    rows = items(spark, item(produto='A, "B"', valor_total_venda=1e7, responsavel=None)).coalesce(1)
    (text,) = part_lines(export_csv(rows, str(tmp_path / "csv")))
    header, line = text.rstrip("\n").split("\n")
    assert header == ",".join(ITEM.fieldNames())
    assert line.startswith('"A, ""B""",2025-01-15,001,') and ",10000000.0,2.0,UN,,FERR" in line
    (empty,) = part_lines(export_csv(items(spark).coalesce(1), str(tmp_path / "vazio")))
    assert empty.strip() == ",".join(ITEM.fieldNames())


def test_parquet_by_month(spark, tmp_path):
    rows = items(spark, item(), item(data_emissao=date(2025, 2, 1)), item(data_emissao=None))
    path = export_parquet(rows, str(tmp_path / "mes"), by_month=True)
    assert sorted(p.rsplit("=")[-1] for p in glob.glob(f"{path}/mes=*")) == [
        "2025-01", "2025-02", "NaT"]
    assert spark.read.parquet(path).filter("mes = '2025-02'").first().data_emissao == date(2025, 2, 1)


def test_json(spark, tmp_path):
    rows = items(spark, item(produto="AÇÃO"), item(data_emissao=None, responsavel=None)).coalesce(1)
    (text,) = part_lines(export_json(rows, str(tmp_path / "json")))
    first, second = map(json.loads, text.splitlines())
    assert first["data_emissao"] == "2025-01-15" and first["produto"] == "AÇÃO"
    assert second["data_emissao"] == "None" and second["responsavel"] is None
    plain = json.loads(json_lines(rows, date_as_str=False).first().value)
    assert plain["data_emissao"] == 1736899200000


def test_markdown(spark, tmp_path):
    top = "codigo string, descricao string, total double"
    kpis = {
        "global": spark.createDataFrame(
            [(10000.0, 15, 50, 666.67)],
            "total_faturamento double, qtd_notas_fiscais bigint, total_itens bigint,"
            " ticket_medio double"),
        "top_produtos_valor": spark.createDataFrame(
            [("0001", "PRODUTO TOP " + "x" * 80, 5000.0), ("0002", "PRODUTO B", 3000.0)], top),
        "top_produtos_qtd": spark.createDataFrame([("0003", "UNIDADE", 100.0)], top),
        "vendas_por_mes": spark.createDataFrame(
            [("2025-02", 5000.0), ("2025-01", 5000.0)], "mes string, total double"),
    }
    (text,) = part_lines(export_markdown(kpis, str(tmp_path / "md")))
    assert text.splitlines()[:10] == [
        "# Relatório de KPIs", "", "## Métricas Globais", "", "| Métrica | Valor |",
        "|---------|------:|", "| Faturamento total | R$ 10_000.00 |", "| Notas fiscais | 15 |",
        "| Itens vendidos | 50 |", "| Ticket médio | R$ 666.67 |"]
    assert "| 1 | 0001 | " + ("PRODUTO TOP " + "x" * 80)[:60] + " | R$ 5_000.00 |" in text
    assert "| 1 | 0003 | UNIDADE | 100 |" in text
    assert text.index("| 2025-01 |") < text.index("| 2025-02 |") and text.endswith("|\n\n")
    empty = {"global": kpis["global"], "vendas_por_mes": kpis["vendas_por_mes"].limit(0)}
    (short,) = part_lines(export_markdown(empty, str(tmp_path / "md2")))
    assert "##" in short and "Top" not in short and "Mês" not in short


def test_pipeline(spark, tmp_path):
    raw = spark.createDataFrame(_workbook("a.xlsx") + _workbook("b.xlsx"), RAW_GRID)
    raw.write.parquet(str(tmp_path / "grid"))
    result = run_pipeline(read_grid(spark, str(tmp_path / "grid")), str(tmp_path / "out"),
                          audit_path=str(tmp_path / "audit"))
    stages = result.etapas
    assert (stages["ingestao"]["linhas"], stages["consolidacao"]["linhas"],
            stages["consolidacao"]["removidas"]) == (10, 5, 5)
    assert result.dados.count() == 5 and "copias" not in result.dados.columns
    assert result.kpis["global"][0]["total_faturamento"] == 600.0
    assert {r.arquivo_origem for r in result.dados.collect()} == {"a.xlsx"}
    assert sum(t.count("\n") - 1 for t in part_lines(stages["csv"]["destino"])) == 5
    again = run_pipeline(read_grid(spark, str(tmp_path / "grid")), str(tmp_path / "out"),
                         audit_path=str(tmp_path / "audit"))
    assert again.kpis == result.kpis
    runs = audit_summary(spark.read.parquet(str(tmp_path / "audit"))).collect()
    assert len(runs) == 2
    for r in runs:
        assert r.sucesso and r.resumo.startswith("✓ 6 etapas, 30 linhas, ") and r.resumo.endswith("s")
    assert stages["ingestao"].get("duracao_s") is None and stages["csv"]["duracao_s"] > 0
    stored = spark.read.parquet(stages["parquet"]["destino"])
    assert "copias" not in stored.columns


def test_a_failing_run_leaves_its_error(spark, tmp_path):
    broken = [("a.xlsx", n, [("Artigo: A", None, None, None)]) for n in (1, 3)]
    with pytest.raises(Exception):
        run_pipeline(spark.createDataFrame(broken, RAW_GRID), str(tmp_path / "out"),
                     audit_path=str(tmp_path / "audit"))
    row = audit_summary(spark.read.parquet(str(tmp_path / "audit"))).first()
    assert (row.n_etapas, row.n_erros, row.sucesso) == (0, 1, False)
    assert row.resumo == "✗ 0 etapas, 0 linhas, 0.0s | 1 erro(s)"


def test_audit(spark, tmp_path):
    path = str(tmp_path / "audit")
    append_audit(spark, path, {"ingestao": {"linhas": 100, "duracao_s": 2.5},
                               "padronizacao": {"linhas": 100, "duracao_s": 0.3}})
    row = audit_summary(spark.read.parquet(path)).first()
    assert row.sucesso and row.duracao_total_s == 2.8
    assert row.resumo == "✓ 2 etapas, 200 linhas, 2.8s"


def test_work_dir_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    shared = Session(spark__checkpoint__dir="s3a://x/y/", spark__master="yarn")
    assert work_dir(shared, "t").startswith("s3a://x/y/caderneta-t-")
    with pytest.raises(RuntimeError):
        work_dir(Session(spark__master="yarn"), "t")


def test_kpi_input_from_items(spark):
    df = spark.createDataFrame(KPI_ROWS, KPI_SCHEMA)
    assert set(compute_kpis(df)) == {
        "global", "top_produtos_valor", "top_produtos_qtd", "vendas_por_mes"}
    assert standardize(items(spark, item(data_emissao=date(2025, 1, 15)))).select(
        F.length("id_venda")).first()[0] == 23
