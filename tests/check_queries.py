"""Run every registered query beside its SQL and compare the rows.

    python tests/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from rollgraph.session import build_session  # noqa: E402


def normal(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = queries()[name](spark, sf)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        except Exception as error:  # report and go on with the next query
            print(f"FAIL  {name}: {type(error).__name__}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        took = time.time() - started
        started = time.time()
        sql = oracle_sql().get(name)
        if sql is None:
            print(f"rows  {name} {len(got[1])} rows {took:.1f}s", flush=True)
            continue
        try:
            cursor = con.execute(sql)
            want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
        except Exception as error:
            print(f"SQL   {name}: {str(error)[:600]}", flush=True)
            bad += 1
            continue
        ok = got == want
        bad += not ok
        print(
            f"{'ok   ' if ok else 'DIFF '} {name} {len(got[1])} rows {took:.1f}s"
            f" sql {time.time() - started:.1f}s",
            flush=True,
        )
        if not ok:
            print("  columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            only = [r for r in got[1] if r not in set(want[1])][:3]
            missing = [r for r in want[1] if r not in set(got[1])][:3]
            print("  spark only", only)
            print("  sql only  ", missing)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
