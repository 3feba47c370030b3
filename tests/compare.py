"""Compare every registered query with its SQL in DuckDB: ``python tests/compare.py [folder] [names…]``."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as driver  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).rsplit(".", 1)[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def _sorted(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in data]
    return [names[i] for i in order], sorted(plain, key=repr)


def difference(spark, connection, name: str, folder: str) -> str | None:
    """None when the query equals its SQL, else what differs."""
    frame = driver.queries()[name](spark, folder)
    got_names, got = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = connection.execute(sql)
    want_names, want = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    if not got:
        return "no rows on either side"
    for left, right in zip(got, want):
        if left != right:
            return f"row {left} != {right}"
        kinds = [(type(a), type(b)) for a, b in zip(left, right) if a is not None and type(a) is not type(b)]
        if kinds:
            return f"types {kinds}"
    return None


def main() -> int:
    from millrace.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(driver.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, connection, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failures} of {len(names)} equal")
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
