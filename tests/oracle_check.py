"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Comparison: row count, column names, and the multiset of rows (doubles
compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from riskforge.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if type(v).__name__ == "Decimal":
        return _norm(float(v))
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, keys=None) -> dict:
    import __spark_entry__ as E
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            out[k] = {"status": "spark_error", "error": repr(e)[:400]}
            continue
        rec = {"rows": len(srows), "sec": round(time.time() - t0, 2)}
        if k not in oracle:
            rec["status"] = "rows_only"
            out[k] = rec
            continue
        try:
            res = con.execute(oracle[k])
            dcols = [d[0] for d in res.description]
            drows = [dict(zip(dcols, r)) for r in res.fetchall()]
        except Exception as e:  # noqa: BLE001
            rec.update(status="sql_error", error=repr(e)[:400])
            out[k] = rec
            continue
        if sorted(scols) != sorted(dcols):
            rec.update(status="schema_mismatch", spark=scols, duck=dcols)
        elif len(srows) != len(drows):
            rec.update(status="count_mismatch", duck_rows=len(drows))
        else:
            cols = sorted(scols)
            a, b = _rows(srows, cols), _rows(drows, cols)
            if a == b:
                rec["status"] = "match"
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                rec.update(status="value_mismatch", cols=cols, diff=repr(diff)[:600])
        out[k] = rec
    return out


if __name__ == "__main__":
    from riskforge.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session(8)
    for kv in filter(None, os.environ.get("ORACLE_CHECK_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    res = compare(spark, sf, keys)
    for k, v in res.items():
        print(k, v)
    bad = [k for k, v in res.items() if v["status"] not in ("match", "rows_only")]
    print("SUMMARY", len(res), "checked;", len(bad), "bad:", bad)
