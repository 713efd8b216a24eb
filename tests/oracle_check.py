"""Run registered queries against their SQL: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].dt.date
        if df[c].dtype == object and len(df) and df[c].notna().any() and type(df[c].dropna().iloc[0]).__name__ == "Decimal":
            df[c] = df[c].astype(float)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """First difference as text; values must be equal, not just close."""
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} vs {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    a, b = normal(mine), normal(theirs)
    for c in a.columns:
        kinds = {a[c].dtype.kind, b[c].dtype.kind}
        if kinds & {"f"} and not kinds & {"f", "i", "u"} == kinds:
            return f"{c}: types {a[c].dtype} vs {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{c}: {int((~same).sum())} values differ, first {a[c][i]!r} vs {b[c][i]!r}"
    return None


def main() -> int:
    from demandloom.session import local_session
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    sql, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            mine = fn(spark, folder).toPandas()
            took = time.time() - start
            bad = difference(mine, con.execute(sql[name]).df()) if name in sql else None
        except Exception as e:
            bad, took, mine = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start, []
        failed += bad is not None
        print(f"{'FAIL' if bad else 'ok' if name in sql else 'rows'} {name} {len(mine)} rows {took:.1f}s {bad or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
