"""Run registered queries against their SQL in DuckDB.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from frameml.sources.tables import TABLES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} / {sorted(rel.columns)}"
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    if spark_types != duck_types:
        return f"types {spark_types} / {duck_types}"
    order = [rel.columns.index(n) for n in names]
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    theirs = sorted((tuple(r[k] for k in order) for r in rel.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, e.g. {wrong[:3]}" if wrong else None


def main(argv):
    import __spark_entry__ as entry
    from tests.session import make_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark, con = make_session(), connect(folder)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = compare(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
            ok = problem is None or name not in oracles
        except Exception as error:
            problem, ok = "".join(traceback.format_exception_only(error))[:1500], False
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
