"""Run registered queries against their SQL twins and report differences.

``python -m checks.compare <sf_dir> [name ...]``
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

from varve.session import get_session

from .registry import ORACLES, QUERIES


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str:
    frame = QUERIES[name](spark, sf_dir)
    mine, my_names = _rows(frame.columns, frame.collect())
    if name not in ORACLES:
        return f"{len(mine)} rows, no twin"
    cursor = con.execute(ORACLES[name])
    theirs, their_names = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if my_names != their_names:
        return f"DIFFERENT columns {set(my_names) ^ set(their_names)}"
    if mine != theirs:
        a, b = set(mine), set(theirs)
        only_mine, only_theirs = sorted(a - b)[:2], sorted(b - a)[:2]
        return f"DIFFERENT {len(mine)} vs {len(theirs)} rows, {len(a - b)}/{len(b - a)} apart\n  {my_names}\n  spark {only_mine}\n  duck  {only_theirs}"
    return f"ok {len(mine)} rows"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.monotonic()
        try:
            verdict = compare(spark, con, name, sf_dir)
        except Exception as error:
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += not verdict.startswith("ok") and "no twin" not in verdict
        print(f"{name}: {verdict} ({time.monotonic() - started:.1f}s)", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
