"""Run a registered query and its SQL twin and compare them as multisets of rows.

As a script: ``python -m tests.compare [sf_dir] [query ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def _kinds(rows: Counter) -> list[set[str]]:
    width = len(next(iter(rows))) if rows else 0
    return [{type(row[i]).__name__ for row in rows if row[i] is not None} for i in range(width)]


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL result; empty when they agree."""
    wanted = con.execute(sql)
    names = [d[0] for d in wanted.description]
    expected = _rows(names, wanted.fetchall())
    got = _rows(df.columns, (tuple(row) for row in df.toLocalIterator()))
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} instead of {sorted(names)}")
    if got.total() != expected.total():
        found.append(f"{got.total()} rows instead of {expected.total()}")
    if _kinds(got) != _kinds(expected):
        found.append(f"types {_kinds(got)} instead of {_kinds(expected)}")
    extra, missing = got - expected, expected - got
    if extra or missing:
        found.append(f"extra {list(extra.items())[:3]}, missing {list(missing.items())[:3]}")
    return found


def main(argv: list[str]) -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from topicframe.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(entry.queries())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = connect(sf_dir)
    failed = 0
    for name in chosen:
        began = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            found = differences(df, con, sql) if sql else [f"no sql; {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - began:.1f}s {' | '.join(found)}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
