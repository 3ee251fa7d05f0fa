"""Compare the catalogue with its SQL: python tests/compare.py [sf_dir] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both sides agree in columns, types' kind, row count and values."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry_module
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf_dir)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            if name in oracles:
                verdict = difference(spark, con, sf_dir, queries[name], oracles[name]) or "ok"
            else:
                found = queries[name](spark, sf_dir).collect()
                verdict = f"{len(found)} rows, no SQL: {found[:12]}"
        except Exception as e:  # report and go on
            verdict = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)
