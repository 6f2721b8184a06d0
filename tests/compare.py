"""Run registered queries against their SQL on the same tables and report differences.

Usage: python tests/compare.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}{'/*' if path.is_dir() else ''}')")
    return con


def kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return type(value).__name__
    if isinstance(value, datetime.datetime):
        return "timestamp"
    return type(value).__name__


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted([tuple(plain(r[i]) for i in order) for r in rows])
    kinds = [{kind(r[i]) for r in rows} - {None} for i in order]
    return names, data, kinds


def compare(spark_df, con, sql) -> str:
    """Empty when equal, else what differs first."""
    left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    right = rows_of([c[0] for c in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}\n   {left[1][:3]}\n   {right[1][:3]}"
    for name, a, b in zip(left[0], left[2], right[2]):
        if a and b and a != b:
            return f"type of {name}: {a} / {b}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(left[0], a, b) if x != y]
            return f"values {cells}\n   {a}\n   {b}"
    return ""


def main(folder: str, prefixes: list[str]) -> int:
    import __spark_entry__ as entry
    from strata.session import local_session

    spark = local_session()
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        begin = time.time()
        try:
            if name in sql:
                message = compare(build(spark, folder), con, sql[name])
            else:
                message = "" if build(spark, folder).count() >= 0 else "?"
                name += " (no SQL)"
        except Exception as error:  # noqa: BLE001
            message = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {time.time() - begin:5.1f}s {name} {message}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    place = arguments.pop(0) if arguments and arguments[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(min(main(place, arguments), 1))
