"""Run registered queries and their SQL side by side: ``python tests/compare.py sf0.01 [names…]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

#: The smallest data set, on which the tests run.
SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """None if both sides have the same columns and rows, else a description."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = canonical(names, cursor.fetchall())
    actual = canonical(spark_df.columns, spark_df.collect())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    if len(expected) != len(actual):
        return f"{len(actual)} rows instead of {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if repr(a) != repr(e)]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main(scale: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from daypanel.session import local_session

    spark, sf_dir = local_session(), f"/root/testdata/{scale}"
    connection, checks, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            if name in checks:
                found = differences(df, connection, checks[name])
                note = found or f"same {df.count()} rows"
            else:
                found, note = None, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            found = note = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name:28s} {time.time() - began:6.1f}s  {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
