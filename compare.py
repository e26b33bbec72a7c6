"""Run registered queries and their SQL counterparts side by side and compare all values.

    python compare.py [--dir /root/testdata/sf0.01] [query ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import tempfile
import time

TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
         "BOOLEAN": "boolean", "INTEGER": "int"}


def open_duckdb(folder: str):
    import duckdb

    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


def compare(spark, db, query, folder: str) -> list[str]:
    """Differences between the two results, empty if there are none."""
    df = query(spark, folder)
    ours = [f.name for f in df.schema]
    names = sorted(ours)
    rows = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    result = db.execute(query.sql)
    theirs = [d[0] for d in result.description]
    if sorted(theirs) != names:
        return [f"columns {names} and {sorted(theirs)}"]
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    problems = [
        f"{f.name} is {f.dataType.simpleString()} and {kinds[f.name]}"
        for f in df.schema if f.dataType.simpleString() != kinds[f.name]
    ]
    order = [theirs.index(n) for n in names]
    expected = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    if len(rows) != len(expected):
        problems.append(f"{len(rows)} and {len(expected)} rows")
    different = [(a, b) for a, b in zip(rows, expected) if not all(map(_same, a, b))]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems or ([] if rows else ["(empty)"])


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    args = parser.parse_args()

    from tillwork import session
    from tillwork.registry import all_queries

    spark = session.build(
        "compare", "local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="compare-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = open_duckdb(args.dir)
    bad = 0
    for name, query in all_queries().items():
        if args.names and not any(n in name for n in args.names):
            continue
        begin = time.time()
        try:
            if query.sql is None:
                problems = [f"(no SQL) {query(spark, args.dir).count()} rows"]
            else:
                problems = compare(spark, db, query, args.dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        fine = not problems or problems[0].startswith("(")
        bad += not fine
        print(f"{'ok ' if fine else 'BAD'} {time.time() - begin:6.1f}s {name} "
              + "; ".join(problems), flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
