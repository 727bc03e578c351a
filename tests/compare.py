"""Run registered queries against their SQL twins in DuckDB: ``python tests/compare.py SF_DIR [NAME ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, sf_dir, name, query, sql):
    """None if both sides give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {df.columns} / {expected_columns}"
    left, right = rows_of(df.columns, rows), rows_of(expected_columns, expected_rows)
    types = [{type(v) for r in s for v in r} - {type(None)} for s in (left, right)]
    if left != right:
        return f"{len(rows)}/{len(expected_rows)} rows; only here {list((left - right))[:3]}; only there {list((right - left))[:3]}"
    return None if types[0] == types[1] or not rows else f"types {types}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.session import session

    spark = session()
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    oracles, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            problem = compare(spark, sf_dir, name, query, oracles.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("failed:", failed)
