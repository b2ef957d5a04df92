"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

    python -m checks.compare [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

from checks.oracles import ORACLES
from roadlark.plans.registry import QUERIES
from roadlark.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return f"{type(value).__name__}:{value}"

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


# Spark type -> DuckDB type of the same values.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, con, name: str, sf_dir: str) -> tuple[str | None, int]:
    """(description of the first difference or None, number of rows)."""
    df = QUERIES[name](spark, sf_dir)
    ours = df.collect()
    if name not in ORACLES:
        return None, len(ours)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}", len(ours)
    other = {n: (t, types[n]) for n, t in df.dtypes if TYPES.get(t) != types[n]}
    if other:
        return f"types {other}", len(ours)
    a, b = canonical(ours, df.columns), canonical(theirs, columns)
    if a == b:
        return None, len(ours)
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)} vs {len(b)}; {len(only_a)} differ\n  spark {only_a[:2]}\n  duck  {only_b[:2]}", len(ours)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in args.names or QUERIES:
        started = time.time()
        try:
            problem, rows = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += problem is not None
        note = "" if name in ORACLES else " (no SQL)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{note} rows={rows} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
