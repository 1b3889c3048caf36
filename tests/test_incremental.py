import functools
import glob
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from caderneta.catalog.queries import _printed, _put_workbooks
from caderneta.operators.calendar import overlapping_files, supersede_partial
from caderneta.operators.report_grid import flat_items
from caderneta.plans import incremental, months
from caderneta.plans.pipeline import run_pipeline
from caderneta.schemas import ITEM, RAW_GRID
from caderneta.sinks.files import export_bi_csv, export_csv, read_bi_csv, read_csv
from caderneta.sources.grid import ingest_grid, parse_grid
from caderneta.sources.report_text import read_report_lines
from test_operators import _cells, _workbook, item, items


def one_workbook(spark, name, n):
    """The first rows of the test workbook: ``n`` more items than its headings."""
    rows = [r for r in _workbook(name) if r[1] <= 3 + n]
    return spark.createDataFrame(rows, RAW_GRID)


def raised(action):
    with pytest.raises(Exception, match="arquivo_origem"):
        action()


def test_a_missing_file_name_fails_the_job(spark):
    typed = one_workbook(spark, "a.xlsx", 3).withColumn("arquivo_origem", F.lit(None).cast("string"))
    raised(lambda: ingest_grid(typed).collect())
    flat = [(None, 7, _cells("01 - A", dt=45672.5, pr=794925.0, nf="001-1", vl=9.5, qt=1, un=" PC "))]
    raised(lambda: flat_items(spark.createDataFrame(flat, RAW_GRID)).collect())
    with pytest.raises(Exception):
        parse_grid(typed).collect()
    rows = items(spark, item(arquivo_origem=None), item())
    raised(lambda: supersede_partial(rows).collect())
    raised(lambda: overlapping_files(rows).collect())
    undated = items(spark, item(arquivo_origem=None, data_emissao=None), item())
    assert supersede_partial(undated).count() == 2


ODD = ["two\nlines", "\u0001", "\u0001\u0001x", 'q"u"o', "", None, "a,b", "\u0001x"]


def test_odd_texts_in_files(spark, tmp_path):
    rows = items(spark, *[item(responsavel=t, protocolo=str(k)) for k, t in enumerate(ODD)])
    back = read_csv(spark, export_csv(rows, str(tmp_path / "csv")), rows.schema)
    assert {r.protocolo: r.responsavel for r in back.collect()} == {str(k): t for k, t in enumerate(ODD)}
    path = export_bi_csv(rows.repartition(3), str(tmp_path / "bi"))
    assert not any(b"\x00" in open(p, "rb").read() for p in glob.glob(f"{path}/part-*"))
    back = {r.protocolo: r for r in read_bi_csv(spark, path, rows.schema).collect()}
    assert {k: r.responsavel for k, r in back.items()} == {str(k): t or "" for k, t in enumerate(ODD)}
    assert all(r.data_emissao == date(2025, 1, 15) for r in back.values())
    empty = export_bi_csv(items(spark), str(tmp_path / "vazio"))
    (text,) = [open(p).read() for p in glob.glob(f"{empty}/part-*")]
    assert text.startswith('"produto",') and text.count("\n") == 1


def test_compressed_files_are_read_back(spark, tmp_path):
    """The tables written to be read back; plain files stay the usual."""
    rows = items(spark, *[item(responsavel=t, protocolo=str(k)) for k, t in enumerate(ODD * 50)]).coalesce(2)

    def size(path, suffix):
        found = glob.glob(f"{path}/part-*")
        assert found and all(f.endswith(suffix) for f in found)
        return sum(map(os.path.getsize, found))

    for name, write, read in (("csv", export_csv, read_csv), ("bi", export_bi_csv, read_bi_csv)):
        plain, packed = write(rows, f"{tmp_path}/{name}"), write(rows, f"{tmp_path}/{name}-gz", compression="gzip")
        assert size(packed, ".gz") * 3 < size(plain, (".csv", ".txt"))
        back = [sorted(map(str, read(spark, path, rows.schema).collect())) for path in (plain, packed)]
        assert back[0] == back[1] and len(back[0]) == 400
    lines = spark.range(0, 5000, 1, 3).select(F.rpad(F.col("id").cast("string"), 132, " ").alias("line"))
    found = read_report_lines(spark, _printed(spark, lines, "gzip"), glob="*.csv.gz")
    assert found.select("arquivo_origem", "blk").distinct().count() == 3
    told = found.orderBy("arquivo_origem", "blk", "seq").collect()
    assert [int(r.line) for r in told] == list(range(5000))


def test_whole_error_is_kept(spark, tmp_path):
    name = "x" * 3000 + ".xlsx"
    broken = [(name, n, [("Artigo: A", None, None, None)]) for n in (1, 3)]
    with pytest.raises(Exception) as seen:
        run_pipeline(spark.createDataFrame(broken, RAW_GRID), str(tmp_path / "out"), audit_path=str(tmp_path / "audit"))
    stored = spark.read.parquet(str(tmp_path / "audit")).first().erro
    assert stored == f"{type(seen.value).__name__}: {seen.value}"


# --- overlapping periods -----------------------------------------------------


def test_overlapping_pairs(spark):
    periods = {"a": (0, 400), "b": (10, 20), "c": (20, 33), "d": (21, 21), "e": (0, 400), "f": (401, 500),
               "g": (-5, 0), "h": (1000, 1001)}
    periods |= {f"m{k:02d}": (600 + k, 640) for k in range(30)}  # all in one bucket
    start = date(1969, 12, 20)
    rows = [item(arquivo_origem=f, data_emissao=start + timedelta(days=d)) for f, ends in periods.items() for d in ends]
    found = {(r.arquivo_a, r.arquivo_b): (r.inicio, r.fim, r.dias) for r in overlapping_files(items(spark, *rows)).collect()}
    expected = {}
    for x, (a, b) in periods.items():
        for y, (c, d) in periods.items():
            if x < y and max(a, c) <= min(b, d):
                lo, hi = max(a, c), min(b, d)
                expected[x, y] = (start + timedelta(days=lo), start + timedelta(days=hi), hi - lo + 1)
    assert found == expected
    plan = overlapping_files(items(spark, *rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "cross" not in plan.lower()
    assert overlapping_files(items(spark)).count() == 0


# --- months --------------------------------------------------------------------


def stored_rows(spark, table):
    return sorted(map(str, months.stored_months(spark, table).select(*ITEM.fieldNames()).collect()))


def files_of(table):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{table}/dados/*/*/*.parquet")}


def test_only_changed_months_are_written(spark, tmp_path):
    table = str(tmp_path / "meses")
    january = [item(protocolo=str(k)) for k in range(3)]
    february = [item(protocolo=str(k), data_emissao=date(2025, 2, k + 1), arquivo_origem="b.xlsx") for k in range(4)]
    undated = [item(data_emissao=None)]
    assert months.replace_months(items(spark, *january, *february, *undated), table) == ["2025-01", "2025-02", "NaT"]
    before = files_of(table)
    assert months.replace_months(items(spark, *undated, *february, *january), table) == []
    assert files_of(table) == before
    fuller = [item(protocolo=str(k), arquivo_origem="c.xlsx") for k in range(9)]
    now = items(spark, *january, *fuller, *february, *undated)
    assert months.replace_months(now, table) == ["2025-01"]
    assert {p: t for p, t in files_of(table).items() if p in before} == before
    assert {p.split("mes=")[1][:7] for p in files_of(table) if p not in before} == {"2025-01"}
    assert stored_rows(spark, table) == sorted(map(str, supersede_partial(now).select(*ITEM.fieldNames()).collect()))
    assert months.replace_months(items(spark, *fuller, *undated), table) == []
    assert months.stored_months(spark, table).filter("mes = '2025-02'").count() == 0
    assert months.stored_months(spark, table, version=1).count() == 8


def test_a_dead_update_changes_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "meses")
    months.replace_months(items(spark, item()), table)
    before = stored_rows(spark, table)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(months, "write_version", dies)
        with pytest.raises(RuntimeError):
            months.replace_months(items(spark, item(), item(protocolo="9")), table)
    assert stored_rows(spark, table) == before
    assert months.replace_months(items(spark, item(), item(protocolo="9")), table) == ["2025-01"]
    assert len(stored_rows(spark, table)) == 2
    assert months.replace_months(items(spark), str(tmp_path / "none")) == []


# --- ingest by manifest ----------------------------------------------------------


def put(spark, folder, name, sheets):
    """One file with the workbooks of ``sheets``: name -> number of items."""
    grids = [one_workbook(spark, sheet, n) for sheet, n in sheets.items()]
    whole = grids[0]
    for more in grids[1:]:
        whole = whole.unionByName(more)
    whole.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def test_only_new_files_are_parsed(spark, tmp_path, monkeypatch):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    parsed = []
    parse = incremental._parsed
    monkeypatch.setattr(incremental, "_parsed", lambda s, paths: parsed.append(len(paths)) or parse(s, paths))

    def full():
        grid = spark.read.schema(RAW_GRID).option("recursiveFileLookup", "true").parquet(folder)
        return sorted(map(str, ingest_grid(grid).select(*ITEM.fieldNames()).collect()))

    def run():
        result = incremental.ingest_new(spark, folder, state)
        rows = sorted(map(str, result.itens.select(*ITEM.fieldNames()).collect()))
        assert rows == full()
        return result.lidos, result.mantidos, result.removidos, result.versao

    put(spark, folder, "a", {"a.xlsx": 3, "b.xlsx": 2})
    put(spark, folder, "b", {"c.xlsx": 4})
    assert run() == (2, 0, 0, 1)
    assert run() == (0, 2, 0, 1) and parsed == [2]
    put(spark, folder, "c", {"d.xlsx": 5})
    assert run() == (1, 2, 0, 2)
    put(spark, folder, "b", {"c.xlsx": 1})  # another file in its place
    assert run() == (1, 2, 1, 3) and parsed == [2, 1, 1]
    (touched,) = glob.glob(f"{folder}/a/part-*")
    os.utime(touched, (1e9, 1e9))
    assert run() == (0, 3, 0, 4) and parsed == [2, 1, 1]
    put(spark, str(tmp_path / "other"), "z", {"z.xlsx": 6})
    content = open(glob.glob(f"{tmp_path}/other/z/part-*")[0], "rb").read()
    with open(touched, "wb") as file:  # a changed file keeps its name
        file.write(content)
    crc = touched.replace("part-", ".part-") + ".crc"
    if os.path.exists(crc):
        os.remove(crc)
    assert run() == (1, 2, 0, 5)

    def dies(*_):
        raise RuntimeError("lost")

    before = sorted(map(str, incremental.known_items(spark, state).collect()))
    put(spark, folder, "e", {"e.xlsx": 2})
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "write_version", dies)
        with pytest.raises(RuntimeError):
            incremental.ingest_new(spark, folder, state)
    assert sorted(map(str, incremental.known_items(spark, state).collect())) == before
    assert run() == (1, 3, 0, 6)


def test_an_empty_folder(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    result = incremental.ingest_new(spark, folder, str(tmp_path / "state"))
    assert (result.lidos, result.mantidos, result.removidos, result.versao) == (0, 0, 0, 0)
    assert result.itens.count() == 0


def test_workbooks_are_dealt_out_whole(spark, tmp_path):
    sheets = [one_workbook(spark, name, 2) for name in "abcdefg"]
    rows = functools.reduce(lambda x, y: x.unionByName(y), [*sheets, sheets[0].withColumn("arquivo_origem", F.lit(None).cast("string"))])
    for files, count in ((None, 8), (4, 4)):
        path = f"{tmp_path}/{files}"
        _put_workbooks(rows, path, files)
        found = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.collect_set("arquivo_origem").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
        assert len(found) == count and sum(r.rows for r in found) == rows.count()
        names = [n for r in found for n in r.n]
        assert sorted(names) == list("abcdefg") and max(len(r.n) for r in found) <= -(-7 // count)
    _put_workbooks(rows.filter("row_no < 0"), f"{tmp_path}/none")
    assert spark.read.schema(RAW_GRID).parquet(f"{tmp_path}/none").count() == 0


# --- stream ----------------------------------------------------------------------


def test_a_stream_of_files_equals_a_full_run(spark, tmp_path, monkeypatch):
    folder, parsed = str(tmp_path / "in"), []
    for k in range(4):
        one_workbook(spark, f"{k}.xlsx", 2 + k).coalesce(1).write.parquet(f"{folder}/{k}")
    columns = ITEM.fieldNames()
    full = sorted(map(str, ingest_grid(spark.read.schema(RAW_GRID).parquet(*glob.glob(f"{folder}/*"))).select(*columns).collect()))
    plain = incremental._parsed
    monkeypatch.setattr(incremental, "_parsed", lambda spark, paths: parsed.extend(paths) or plain(spark, paths))
    for files in (3, 100):
        done = incremental.ingest_stream(spark, folder, str(tmp_path / f"s{files}"), str(tmp_path / f"c{files}"), files)
        assert (done.lidos, done.mantidos) == (4, 0)
        assert sorted(map(str, done.itens.select(*columns).collect())) == full
    # A batch whose manifest is written, but which the stream does not know as done, is not parsed again.
    parsed.clear()
    state, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    write = incremental.write_version

    def dies_after(table, path):
        if write(table, path) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_version", dies_after)
    with pytest.raises(Exception, match="lost"):
        incremental.ingest_stream(spark, folder, state, checkpoint, 1)
    monkeypatch.setattr(incremental, "write_version", write)
    again = incremental.ingest_stream(spark, folder, state, checkpoint, 1)
    assert (again.lidos, again.mantidos) == (2, 1) and len(parsed) == len(set(parsed)) == 4
    assert sorted(map(str, again.itens.select(*columns).collect())) == full
    assert incremental.ingest_stream(spark, folder, state, checkpoint).lidos == 0
    assert incremental.ingest_new(spark, folder, state).lidos == 0
