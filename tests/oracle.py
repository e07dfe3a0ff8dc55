"""Compare a registered query with its SQL, value by value.

Run as a script to check queries by name: ``python tests/oracle.py [--sf 0.01] [prefix ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def difference(df, con, text: str) -> str | None:
    """What differs between a frame and the SQL's result, or None."""
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(text)
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]).upper() for c in cursor.description}
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    simple = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}
    mismatched = {n: (t, types[n]) for n, t in df.dtypes if simple.get(t, t.upper()) != types[n]}
    if mismatched:
        return f"types {mismatched}"
    left, right = rows_of(df.columns, got), rows_of(names, want)
    if len(left) != len(right):
        return f"rows {len(left)} against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} rows, first {wrong[0]}"
    return None


def main() -> int:
    from marketlane import registry, scratch, session

    args = sys.argv[1:]
    sf = "0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = session.build(8)
    con = connect(folder)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if args and not any(name.startswith(p) for p in args):
            continue
        start = time.time()
        try:
            if name in registry.ORACLES:
                problem = difference(fn(spark, folder), con, registry.ORACLES[name])
                kind = "equal"
            else:
                problem, kind = None, f"{len(fn(spark, folder).collect())} rows"
        except Exception as error:
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or kind}", flush=True)
    scratch.clear(spark)
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
