"""Compare registered queries with their SQL forms in DuckDB."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _rows(columns, rows):
    """Rows as text, columns by name, in any order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def _plain(value):
    return str(value) if type(value).__name__ in ("Decimal", "date", "datetime") else value


def compare(spark, connection, name, folder):
    """Seconds and a description of the difference (empty when equal)."""
    started = time.time()
    df = entry.queries()[name](spark, folder)
    got = _rows(df.columns, df.collect())
    seconds = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return seconds, len(got), "no SQL form"
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return seconds, len(got), f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if got != expected:
        extra = [row for row in got if row not in set(expected)][:2]
        missing = [row for row in expected if row not in set(got)][:2]
        return seconds, len(got), f"{len(got)} vs {len(expected)} rows; {extra} vs {missing}"
    return seconds, len(got), ""


if __name__ == "__main__":
    from orderloom.session import build_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    folder = f"/root/testdata/{scale}"
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(folder)
    for query in names:
        try:
            seconds, count, problem = compare(session, duck, query, folder)
        except Exception as error:  # noqa: BLE001
            seconds, count, problem = 0, 0, f"{type(error).__name__}: {str(error)[:400]}"
        print(f"{'ok  ' if not problem else 'DIFF'} {query} {seconds:.1f}s {count} {problem}", flush=True)
