"""Run checks in Spark and their SQL in DuckDB on the same folder and compare names, types and rows."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    return round(value, 6) if isinstance(value, float) else tuple(value) if isinstance(value, list) else value


def difference(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    out = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in out.description}
    types = {c: KIND.get(k, k) for c, k in df.dtypes}
    if set(types) != set(expected_types):
        return f"columns {sorted(types)} != {sorted(expected_types)}"
    names = sorted(types)
    order = [list(expected_types).index(n) for n in names]
    want = Counter(tuple(_norm(r[i]) for i in order) for r in out.fetchall())
    got = Counter(tuple(_norm(r[n]) for n in names) for r in df.collect())
    if got != want:
        return (
            f"rows {sum(got.values())} != {sum(want.values())}; only spark {list((got - want).items())[:3]}; "
            f"only sql {list((want - got).items())[:3]} {names}"
        )
    wrong = {n: (types[n], expected_types[n]) for n in names if types[n] != expected_types[n]}
    return f"types {wrong}" if wrong else ""


if __name__ == "__main__":
    import __spark_entry__ as entry

    from kohortflow.session import session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con, bad = session(), connect(folder), []
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            text = difference(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
            ok = not text or text.startswith("no SQL")
        except Exception as error:  # report and go on with the next query
            text, ok = f"{type(error).__name__}: {str(error)[:600]}", False
        if not ok:
            bad.append(name)
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {text}", flush=True)
    print("failed:", bad)
