"""Runs a query in Spark and its SQL in DuckDB and compares the rows.

As a script: `python tests/compare.py [sf dir] [name prefix ...]`.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, repr(float(value) + 0.0))
    return (3, str(value))


def _rows(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, db, sql: str) -> str | None:
    """What differs, or None. Values must be equal to the last digit."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got = [tuple(r) for r in spark_df.collect()]
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    left, right = _rows(spark_df.columns, got), _rows(names, expected)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if not wrong:
        return None
    cells = [(x[1], y[1]) for x, y in zip(*wrong[0]) if x != y]
    return f"{len(wrong)} of {len(left)} rows differ, first: {cells}"


def main() -> int:
    import __spark_entry__ as contract
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, db = make_session(), connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failures = 0
    for name, run in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = difference(df, db, oracles[name])
            else:
                problem = None
                df.collect()
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        note = "" if name in oracles else " (no SQL)"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {time.time() - start:.1f}s{note} {problem or ''}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
