"""Runs queries beside their SQL and compares names, types and all rows.

    python -m tests.oracle_check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
SAME_TYPE = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if hasattr(value, "isoformat"):
        return value.isoformat(" ")
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def ordered(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in at) for row in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} but SQL has {sorted(names)}"
    for name, kind in df.dtypes:
        wanted = kind.upper().replace(",", ",") if kind.startswith("decimal") else SAME_TYPE.get(kind, kind)
        if wanted != types[name]:
            return f"type of {name}: {kind} but SQL has {types[name]}"
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    expected = ordered(names, expected)
    if len(got) != len(expected):
        return f"{len(got)} rows but SQL has {len(expected)}"
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0][0]} but SQL has {wrong[0][1]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    from tidemill.plans import all_queries
    from tidemill.session import build_session

    spark = build_session("oracle check", master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name, q in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            wrong = compare(df, con, q.sql) if q.sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - every query is to be reported
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        bad = wrong is not None and not wrong.startswith("no SQL")
        failed += bad
        print(f"{'BAD ' if bad else 'ok  '} {name} {time.time() - start:.2f}s {wrong or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
