"""Run a registered query and its SQL on the same tables and compare the full results."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    took = round(time.time() - start, 2)
    got_cols, got = _rows(df.columns, got_rows)
    if sql is None:
        return {"name": name, "ok": True, "rows": len(got), "sec": took, "why": "no SQL"}
    res = con.execute(sql)
    want_cols, want = _rows([d[0] for d in res.description], res.fetchall())
    out = {"name": name, "rows": len(got), "sec": took, "ok": got_cols == want_cols and got == want, "why": ""}
    if got_cols != want_cols:
        out["why"] = f"columns {got_cols} != {want_cols}"
    elif not out["ok"]:
        a, b = [r for r in got if r not in set(want)], [r for r in want if r not in set(got)]
        out["why"] = f"rows {len(got)} vs {len(want)}; cols {got_cols}; spark only {len(a)}: {a[:3]}; sql only {len(b)}: {b[:3]}"
    return out
