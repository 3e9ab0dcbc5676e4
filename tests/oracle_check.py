"""Run a registered query on Spark and its oracle SQL on DuckDB, and compare the results.

Comparison: same column names, same row count, and the same multiset of rows after
normalising values (floats rounded, dates and timestamps as ISO text). Usable from pytest
and from the command line: ``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_norm(row[i])) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_cols = df.columns
    spark_rows = df.collect()
    t1 = time.time()
    rel = con.execute(sql)
    duck_cols = [d[0] for d in rel.description]
    duck_rows = rel.fetchall()
    t2 = time.time()
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"{name}: columns differ {sorted(set(spark_cols) ^ set(duck_cols))}"
    if len(spark_rows) != len(duck_rows):
        return False, f"{name}: rows {len(spark_rows)} (spark) != {len(duck_rows)} (duckdb)"
    a = _rows(spark_cols, spark_rows)
    b = _rows(duck_cols, duck_rows)
    if a != b:
        diff_a = list((a - b).items())[:2]
        diff_b = list((b - a).items())[:2]
        return False, f"{name}: values differ spark-only={diff_a} duck-only={diff_b}"
    return True, f"{name}: ok {len(spark_rows)} rows spark {t1 - t0:.1f}s duckdb {t2 - t1:.1f}s"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from erpweave.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names:
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, name, qs[name], sqls[name])
        except Exception as exc:  # noqa: BLE001
            ok, msg = False, f"{name}: error {type(exc).__name__}: {str(exc)[:400]}"
        failed += not ok
        print(msg, flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
