"""Compare registered Spark queries with their DuckDB oracles: row count, column names and an
order-insensitive hash of normalised values.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        return f"{f:.6g}" if abs(f) >= 1e6 else f"{round(f, 6):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h, lines


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT"}


def type_differences(df, con, sql: str) -> dict:
    """Columns whose Spark type and DuckDB oracle type differ (after naming each engine's types
    the same way)."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
          for f in df.schema.fields}
    rel = con.sql(sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name: str, sf_dir: str, verbose: bool = False) -> dict:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s = digest(df.columns, srows)
    out = {"name": name, "spark_sec": round(t1 - t0, 2), "rows": s[0]}
    sql = oracle_sql().get(name)
    if sql is None:
        out["status"] = "rows-only"
        return out
    out["type_diff"] = type_differences(df, con, sql)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    o = digest(cols, res.fetchall())
    out["oracle_rows"] = o[0]
    ok = s[0] == o[0] and s[1] == o[1] and s[2] == o[2] and not out["type_diff"]
    out["status"] = "match" if ok else "MISMATCH"
    if not ok:
        out["spark_cols"], out["oracle_cols"] = s[1], o[1]
        a, b = set(s[3]), set(o[3])
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from terrace.session import build_session
    from __spark_entry__ import queries
    spark = build_session("local[8]")
    con = duck(sf_dir)
    names = argv[2:] or list(queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": str(e)[:400]}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
