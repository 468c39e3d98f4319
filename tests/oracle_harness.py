"""Compare registered Spark queries with their DuckDB oracles.

Mirrors the correctness gate: row count, column names and an
order-insensitive hash of the values (columns sorted by name).

    python -m tests.oracle_harness /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(v)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\x1e")
    return h.hexdigest()


def compare(spark, sf_dir: str, keys=None, verbose=True) -> dict:
    import importlib
    entry = importlib.import_module("__spark_entry__")
    queries, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or list(queries):
        t0 = time.time()
        df = queries[k](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        res = {"rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if k in sqls:
            rel = con.sql(sqls[k])
            d_cols = [c for c in rel.columns]
            d_rows = rel.fetchall()
            res.update(
                oracle_rows=len(d_rows),
                cols_match=sorted(s_cols) == sorted(d_cols),
                hash_match=digest(s_cols, s_rows) == digest(d_cols, d_rows),
            )
            if sorted(s_cols) != sorted(d_cols):
                res["spark_cols"], res["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        out[k] = res
        if verbose:
            print(k, res, flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tessera.session import local_session

    spark = local_session(8, 8)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if "hash_match" in v and not (v["hash_match"] and v["cols_match"])]
    print("MISMATCH:", bad)
