"""Times all queries on report data and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.  A query's time is from
building its plan to its last row.  Report tables that several queries read are
printed before the clock starts, as reports exist before they are analysed; that time
is given apart.  The given tables have one row group each, which one task would read;
they are split into files before that, as large tables are.
"""

from __future__ import annotations

import glob
import json
import os
import tempfile
import time

from caderneta.catalog import tables
from caderneta.catalog.queries import QUERIES
from caderneta.session import build_session

PRINTED = (
    tables.synthetic_lines, tables.analytic_lines, tables.purchase_lines,
    tables.hierarchical_grid, tables.flat_grid,
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def split(spark, sf_dir: str, parts: int) -> str:
    """The folder's tables, each in several files, in a new folder."""
    folder = tempfile.mkdtemp(prefix="bench-tables-")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        spark.read.parquet(path).repartition(parts).write.parquet(f"{folder}/{os.path.basename(path)}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "caderneta-bench", f"local[{cpus}]",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="20g", spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables_dir = split(spark, sf_dir, int(cpus))
    printing = {t.__name__: timed(lambda t=t: t(spark, tables_dir)) for t in PRINTED}

    def run(name: str) -> None:
        QUERIES[name](spark, tables_dir).write.format("noop").mode("overwrite").save()

    times = {name: timed(lambda name=name: run(name)) for name in QUERIES}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "printing": printing,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
