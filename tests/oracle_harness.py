"""Run catalogue queries on Spark and their oracle SQL on DuckDB, compare.

Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``
Comparison: same row count, same column names, and the same multiset of
rows after sorting columns by name (floats rounded to 6 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return float(f"{v:.6g}")
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.6g}")
    except Exception:
        pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if pd.isna(v) if not isinstance(v, (list, tuple, dict)) else False:
        return None
    return str(v) if not isinstance(v, (int, float, bool, str)) else v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only ({len(sdf)} rows)"
            if verbose:
                print(f"{name}: {results[name]} {ts:.1f}s", flush=True)
            continue
        try:
            ddf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        msg = []
        if sorted(sdf.columns) != sorted(ddf.columns):
            msg.append(f"columns {sorted(sdf.columns)} vs {sorted(ddf.columns)}")
        if len(sdf) != len(ddf):
            msg.append(f"rows {len(sdf)} vs {len(ddf)}")
        if not msg:
            a, b = rows_of(sdf), rows_of(ddf)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msg.append(f"values differ, e.g. {diff}")
        results[name] = "OK" if not msg else "; ".join(msg)
        if verbose:
            print(f"{name}: {results[name]} ({len(sdf)} rows, {ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from shopstream.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if not (v == "OK" or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("FAIL", k, v)
