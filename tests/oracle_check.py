"""Run catalog queries in Spark and their SQL in DuckDB and compare results.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, rel: float = 0.0) -> str | None:
    """None when equal, else a description of the first difference."""
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = rows_of(spark_pdf), rows_of(duck_pdf)
    cols = sorted(spark_pdf.columns)
    for ra, rb in zip(a, b):
        for c, x, y in zip(cols, ra, rb):
            if x == y:
                continue
            if rel and isinstance(x, float) and isinstance(y, float) and abs(x - y) <= rel * max(abs(x), abs(y)):
                continue
            return f"column {c}: {x!r} vs {y!r} in {ra} / {rb}"
    return None


def check(spark, sf_dir: str, names=None, rel: float = 0.0, verbose=True) -> dict[str, str | None]:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        if name not in sqls:
            results[name] = "no oracle"
            continue
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            t1 = time.time()
            spdf = sdf.toPandas()
        except Exception as e:  # report and go on with the next query
            results[name] = f"ERROR {type(e).__name__}: {str(e).splitlines()[0][:300]}"
            print(f"{name:28s} {results[name]}", flush=True)
            continue
        t2 = time.time()
        try:
            dpdf = con.execute(sqls[name]).df()
        except Exception as e:
            results[name] = f"ORACLE ERROR {type(e).__name__}: {str(e).splitlines()[0][:300]}"
            print(f"{name:28s} {results[name]}", flush=True)
            continue
        diff = compare(spdf, dpdf, rel)
        results[name] = diff
        if verbose:
            print(f"{name:28s} rows={len(spdf):7d} spark={t2 - t0:6.2f}s (plan {t1 - t0:.2f}s) "
                  f"{'OK' if diff is None else 'DIFF ' + diff}", flush=True)
    return results


if __name__ == "__main__":
    from tickweave.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    res = check(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v}
    print(f"{len(res) - len(bad)}/{len(res)} equal")
