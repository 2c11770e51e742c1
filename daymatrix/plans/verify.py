"""Result comparison for the oracle checks (tests and tools/check_oracle.py).

Row count, column names and an order-insensitive digest of the values with
columns sorted by name, the same shape of check the driver records.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], [columns[i] for i in order], lines


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols, s_rows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    con.execute(f"CREATE OR REPLACE TEMP VIEW expected AS {sql}")  # a statement must be usable as a view
    res = con.sql("SELECT * FROM expected")
    d_cols, d_rows = res.columns, res.fetchall()
    hs, cs, ls = digest(s_cols, s_rows)
    hd, cd, ld = digest(d_cols, d_rows)
    if len(s_rows) == len(d_rows) and cs == cd and hs == hd:
        return True, f"{len(s_rows)} rows, {len(s_cols)} cols"
    if cs != cd:
        return False, f"columns differ: spark-only {sorted(set(cs) - set(cd))[:5]} duck-only {sorted(set(cd) - set(cs))[:5]}"
    a, b = set(ls), set(ld)
    return False, (f"rows {len(s_rows)} vs {len(d_rows)}; spark-only {sorted(a - b)[:2]} "
                   f"duck-only {sorted(b - a)[:2]}")
