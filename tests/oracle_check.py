"""Compare every registered query with its SQL twin on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return ("n", "nan" if math.isnan(number) else round(number, 6) + 0.0)
    if isinstance(value, datetime.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("d", value.isoformat())
    return ("s", str(value))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
            return f"values differ: {diff[:3]}"
    return None


def main() -> None:
    from claimworks import registry, session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    spark = session.build(
        "oracle-check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = registry.oracle_sql()
    failed = []
    for name, query in registry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                note = "equal" if problem is None else problem
            else:
                problem, note = None, f"rows {df.count()} (no SQL)"
        except Exception as exc:  # noqa: BLE001 - the report is the point
            problem = note = f"{type(exc).__name__}: {str(exc)[:1500]}"
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
