"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Comparison mirrors the driver: column names (sorted), row count and an
order-insensitive multiset of rows, with values normalised (NaN -> None,
integral floats -> int) so that only real differences show.

CLI: ``python tests/oracle_harness.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark simple type name -> DuckDB type name of the same values
SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == int(v) and abs(v) < 1e15:
            return int(v)
        return v if os.environ.get("ORACLE_EXACT") else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    out = Counter()
    for rec in pdf.itertuples(index=False, name=None):
        out[tuple(_norm(x) for x in rec)] += 1
    return cols, out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(spdf), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    opdf = rel.df()
    spark_types = {f.name: SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    scols, srows = _rows(spdf)
    ocols, orows = _rows(opdf)
    res = {"name": name, "rows": len(spdf), "oracle_rows": len(opdf), "spark_s": round(t1 - t0, 2)}
    if scols != ocols:
        res.update(ok=False, why=f"columns {scols} vs {ocols}")
    elif spark_types != duck_types:
        res.update(ok=False, why=f"types {spark_types} vs {duck_types}")
    elif srows != orows:
        only_s = list((srows - orows).elements())[:3]
        only_o = list((orows - srows).elements())[:3]
        res.update(ok=False, why=f"values differ; spark-only {only_s} oracle-only {only_o}")
    else:
        res.update(ok=True)
    res["spark_types"] = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from geoindicators.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        if r.get("ok") is False:
            bad += 1
        print({k: v for k, v in r.items() if k != "spark_types"}, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
