"""Run registered queries against their oracles: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

from cambio.session import build_session
from checks.oracle import ORACLE
from checks.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str | None, int]:
    """(difference or None, rows)"""
    frame = REGISTRY[name](spark, sf_dir)
    ours = _bag(frame.columns, frame.collect())
    answer = con.execute(ORACLE[name])
    columns = [d[0] for d in answer.description]
    theirs = _bag(columns, answer.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}", ours.total()
    if ours != theirs:
        only, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"{ours.total()} rows against {theirs.total()}; only here {only}; missing {missing}", ours.total()
    return None, ours.total()


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in argv[1:] or REGISTRY:
        start = time.time()
        try:
            difference, rows = compare(spark, con, name, sf_dir)
        except Exception as error:
            difference, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {name:28} {rows:8} rows {time.time() - start:6.1f} s", flush=True)
        if difference:
            print("    ", difference, flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
