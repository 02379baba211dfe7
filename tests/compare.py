"""Compare queries with their SQL on DuckDB.

``python -m tests.compare SF_DIR [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
PLAIN_TYPES = {"bigint", "double", "string", "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def problem(spark, con, sf_dir, query, sql) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = query(spark, sf_dir)
    odd = [(f.name, f.dataType.simpleString()) for f in df.schema if f.dataType.simpleString() not in PLAIN_TYPES]
    if odd:
        return f"types {odd}"
    got = _rows(df.columns, df.collect())
    relation = con.sql(sql)
    want = _rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} want {sorted(relation.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} want {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"row {g} want {w}"
    if not got:
        return "no rows"
    return None


def main() -> int:
    from chartdex.catalog import load
    from chartdex.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    queries, oracles = load()
    spark, con, failed = local_session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or queries:
        started = time.time()
        try:
            if name in oracles:
                outcome = problem(spark, con, sf_dir, queries[name], oracles[name])
            else:
                outcome = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on to the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        failed += outcome is not None
        print(f"{'FAIL' if outcome else 'ok  '} {name} {time.time() - started:.1f}s {outcome or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
