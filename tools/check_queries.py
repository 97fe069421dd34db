"""Run registered queries and compare them with their SQL on the same tables.

    python tools/check_queries.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from dugout.plans.catalog import ORACLE, QUERIES  # noqa: E402
from dugout.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    base = duckdb.connect()
    for name in TABLES:
        base.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return base


def cell(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (bool, int)):
        return str(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, base, folder, name):
    """Problem text, or None when rows, columns and values agree."""
    result = QUERIES[name](spark, folder)
    got_names, got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    if name not in ORACLE:
        return None if got else "no rows"
    answer = base.execute(ORACLE[name])
    want_names, want = rows_of([d[0] for d in answer.description], answer.fetchall())
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a} instead of {b}"
    return None if got else "empty on both sides"


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    base, failed = connect(folder), 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = compare(spark, base, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree; {len(QUERIES)} queries, {len(ORACLE)} with SQL")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
