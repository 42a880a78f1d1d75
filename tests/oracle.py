"""Run the registered queries beside their SQL in DuckDB and compare the values.

    python -m tests.oracle [query ...]     (ORACLE_SF_DIR picks the data folder)
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(_plain(row[i]) for i in order) for row in rows]


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_names, got = df.columns, [tuple(x) for x in df.collect()]
    cur = con.execute(sql)
    want_names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} vs {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = sorted(_rows(got_names, got), key=repr), sorted(_rows(want_names, want), key=repr)
    for x, y in zip(a, b):
        if repr(x) != repr(y):
            return f"row\n    {x}\n    {y}"
    return None


def main(names: list[str]) -> int:
    from tests.conftest import make_session
    from registry import all_queries, all_sql

    sf = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark, con, bad = make_session(), connect(sf), 0
    queries, sql = all_queries(), all_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            problem = compare(df, con, sql[name]) if name in sql else f"(rows only: {df.count()})"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None and not problem.startswith("(")
        print(f"{'ok ' if problem is None else '   '}{name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(names or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
