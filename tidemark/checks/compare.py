"""Run registered queries beside their SQL and compare the results.

    python -m tidemark.checks.compare DATA_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from tidemark.checks import oracles, queries
from tidemark.session import build_session

TABLES = "region nation customer supplier part orders lineitem events".split()


def sql_connection(data_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(round(value, 6) + 0.0)
    return value if value is None or isinstance(value, bool) else str(value)


def result_rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, data_dir: str, name: str) -> str:
    """Empty text when equal, else what differs."""
    frame = queries.registered()[name](spark, data_dir)
    ours = frame.collect()
    sql = oracles.oracle_sql().get(name)
    if sql is None:
        return ""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    left, right = result_rows(frame.columns, ours), result_rows(names, theirs)
    if left != right:
        return (
            f"rows {len(ours)} / {len(theirs)}; only here {list((left - right).items())[:2]}; "
            f"only in SQL {list((right - left).items())[:2]}"
        )
    return "" if theirs else "both results are empty"


def main(data_dir: str, names: list[str]) -> int:
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(data_dir)
    failures = 0
    for name in names or queries.registered():
        start = time.perf_counter()
        try:
            difference = compare(spark, connection, data_dir, name)
        except Exception as error:  # report and go on with the other queries
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(difference)
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {difference or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
