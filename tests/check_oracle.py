"""Compare registered queries with their SQL twins. Usage: check_oracle.py SF [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return str(value)


def canonical(columns, rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(result, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    found = canonical(result.columns, result.collect())
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    wanted = canonical(names, answer.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows against {len(wanted)}"
    for ours, theirs in zip(found, wanted):
        if ours != theirs:
            return f"{ours} against {theirs}"
    return None


def main() -> None:
    import __spark_entry__ as contract
    from txnguard.session import build_session

    folder = f"/root/testdata/{sys.argv[1]}"
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", **quiet})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles, connection = contract.queries(), contract.oracle_sql(), connect(folder)
    for name in sys.argv[2:] or queries:
        started = time.monotonic()
        try:
            result = queries[name](spark, folder)
            if name in oracles:
                problem = compare(result, connection, oracles[name])
                outcome = problem or "equal"
            else:
                outcome = f"rows only: {len(result.collect())}"
        except Exception as error:  # report and go on with the next query
            outcome = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.monotonic() - started:6.2f}s  {outcome}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
