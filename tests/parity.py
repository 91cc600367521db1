"""Compare the registered queries with their oracle SQL: ``python tests/parity.py [sf] [name...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    result = con.execute(sql)
    theirs = {c[0]: str(c[1]) for c in result.description}
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if ours != theirs:
        return f"schema {sorted(ours.items())} vs {sorted(theirs.items())}"
    want = _sorted_rows(list(theirs), result.fetchall())
    have = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(have) != len(want):
        return f"rows {len(have)} vs {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"first difference {a} vs {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"{DATA}/{scale}"
    spark = make_session()
    con = connect(folder)
    oracle = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = build(spark, folder)
            problem = differences(df, con, oracle[name]) if name in oracle else None
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__} {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - started:6.2f}s {name} {problem or ''}",
              flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
