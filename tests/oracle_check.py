"""Runs registered queries next to their check SQL: python tests/oracle_check.py DIR [name ..]"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    table = df.select(*names).toArrow()
    columns = [c.to_pylist() for c in table.columns]
    return names, Counter(zip(*columns))


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> str:
    """'' when the two results agree, else what differs."""
    names, ours = spark_rows(build(spark, sf_dir))
    expected_names, theirs = oracle_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if ours == theirs:
        kinds = [{type(v) for v in col if v is not None} for col in zip(*ours)]
        other = [{type(v) for v in col if v is not None} for col in zip(*theirs)]
        return "" if kinds == other else f"types {kinds} != {other}"
    extra, missing = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} vs {sum(theirs.values())}; "
        f"only ours {sum(extra.values())}: {list(extra)[:3]}; "
        f"only expected {sum(missing.values())}: {list(missing)[:3]}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from caderneta.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if name not in sql or (wanted and name not in wanted):
            continue
        start = time.perf_counter()
        try:
            problem = compare(spark, con, name, build, sql[name], sf_dir)
        except Exception as error:  # a failing query is reported, the rest still runs
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
