"""Compare registered queries with their SQL: python tests/parity.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def canonical(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    cells = [[None if v is None or v != v else v for v in row] for row in frame.itertuples(index=False)]
    return sorted((tuple(repr(float(v)) if isinstance(v, float) else str(v) for v in row) for row in cells))


def compare(spark, con, folder: str, name: str) -> str:
    start = time.time()
    df = queries()[name](spark, folder)
    got = df.toPandas()
    spent = time.time() - start
    plan = df._jdf.queryExecution().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Join Cross"):
        if forbidden in plan:
            return f"DIFF  {name}: the plan holds a {forbidden}"
    sql = oracle_sql().get(name)
    if sql is None:
        return f"ok    {name}: {len(got)} rows, no SQL, {spent:.1f}s"
    start = time.time()
    want = con.execute(sql).df()
    took = time.time() - start
    if sorted(got.columns) != sorted(want.columns):
        return f"DIFF  {name}: columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in sorted(got.columns) if got[c].dtype != want[c].dtype]
        return f"ok    {name}: {len(a)} rows, {spent:.1f}s, sql {took:.1f}s {kinds or ''}"
    left, right = set(a), set(b)
    return f"DIFF  {name}: rows {len(a)} / {len(b)}, {len(left - right)} only here {sorted(left - right)[:2]}, only SQL {sorted(right - left)[:2]}"[:1500]


if __name__ == "__main__":
    from tokenloom.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = get_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        try:
            print(compare(spark, con, folder, name), flush=True)
        except Exception as error:
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:700]}", flush=True)
