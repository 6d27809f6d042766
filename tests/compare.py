"""Run registered queries against their SQL twins in DuckDB: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return ("f", "nan") if math.isnan(value) else ("f", repr(value))
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, int):
        return ("f", repr(float(value)))
    if isinstance(value, (dt.datetime, dt.date)):
        return ("t", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return ("n", "") if value is None else ("s", str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), sorted(columns)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None):
    started = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    spent = time.time() - started
    if sql is None:
        return f"rows-only {len(got)}", spent, len(got) > 0
    result = connect(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    want, want_names = rows_of(names, result.fetchall())
    have, have_names = rows_of(df.columns, got)
    if want_names != have_names:
        return f"columns differ: {have_names} against {want_names}", spent, False
    if len(want) != len(have):
        return f"rows differ: {len(have)} against {len(want)}", spent, False
    bad = [(a, b) for a, b in zip(have, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(have)} rows differ, first {bad[0]}", spent, False
    return f"equal {len(have)}", spent, True


if __name__ == "__main__":
    import __spark_entry__ as entry_points
    from riskframe.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    sqls = entry_points.oracle_sql()
    failed = []
    for name, fn in entry_points.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            text, spent, good = compare(spark, f"/root/testdata/{sf}", name, fn, sqls.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            text, spent, good = f"{type(error).__name__}: {str(error)[:600]}", 0.0, False
        if not good:
            failed.append(name)
        print(f"{'ok  ' if good else 'FAIL'} {name:24s} {spent:6.2f}s {text}", flush=True)
    print("failed:", failed)
