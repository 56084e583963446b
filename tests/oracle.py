"""Run the registered queries against their SQL in DuckDB and compare the rows.

    python tests/oracle.py [data folder] [query ...]
"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{sf_dir}/{name}.parquet'")
    return connection


def in_spark(frame):
    return _rows(frame.columns, (tuple(row) for row in frame.collect()))


def in_duckdb(connection, sql):
    result = connection.execute(sql)
    return _rows([column[0] for column in result.description], result.fetchall())


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


if __name__ == "__main__":
    from conftest import build_session

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    connection = connect(sf_dir)
    failed = 0
    for name, function in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        ours = in_spark(function(spark, sf_dir))
        seconds = time.time() - started
        sql = contract.oracle_sql().get(name)
        theirs = in_duckdb(connection, sql) if sql else None
        same = "no SQL" if theirs is None else "ok" if ours == theirs else "DIFFERENT"
        failed += same == "DIFFERENT"
        print(f"{name:28} {same:10} {len(ours[1]):8} rows {seconds:6.2f} s", flush=True)
        if same == "DIFFERENT":
            print("  columns", ours[0] == theirs[0], ours[0], theirs[0])
            print("  rows", len(ours[1]), len(theirs[1]))
            for left, right in [(l, r) for l, r in zip(ours[1], theirs[1]) if l != r][:2]:
                print("   ours", left, "\n   sql ", right)
    sys.exit(1 if failed else 0)
