"""Compare the registered queries with their SQL: ``python tests/compare.py [sf_dir] [query ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(row[i]) for i in order) for row in rows]
    body.sort(key=lambda row: tuple((v is not None, str(v)) for v in row))
    return [columns[i] for i in order], body


def compare(spark, connection, sf_dir: str, query, sql: str) -> str | None:
    """None if both give the same rows, otherwise what differs."""
    frame = query(spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for mine, other in zip(*[o[1] for o in (ours, theirs)], strict=True):
        if mine != other:
            return f"{ours[0]}: {mine} / {other}"[:1500]
    return None if ours[1] else "no rows"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from probelake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = build_session("compare", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            difference = compare(spark, connection, sf_dir, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        print(f"{name:24} {time.time() - start:6.2f}s {difference or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
