"""Runs checked queries against DuckDB: ``python -m checks.compare [folder] [name part ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or v != v else v)
        elif str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
    text = df.astype(object).where(df.notna(), None)
    if text.empty:
        return text
    keys = text.map(repr).agg("|".join, axis=1)
    return text.assign(_k=keys).sort_values("_k").drop(columns="_k").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when both hold the same rows in any order."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = {
        c: (str(got[c].dtype), str(want[c].dtype))
        for c in got.columns
        if str(got[c].dtype).replace("[ns]", "[us]") != str(want[c].dtype).replace("[ns]", "[us]")
    }
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)} {kinds or ''}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        bad = [i for i in range(len(a)) if a[c][i] != b[c][i]]
        if bad:
            i = bad[0]
            return f"{len(bad)} values of {c}, first {a[c][i]!r} != {b[c][i]!r} {kinds or ''}"
    return f"types {kinds}" if kinds else ""


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(sf_dir: str = "/root/testdata/sf0.01", *parts: str) -> None:
    from checks import QUERIES, SQL
    from roadlens.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    failed = 0
    for name, run in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        t0 = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            t1 = time.time()
            verdict = "rows-only" if name not in SQL else ""
            if name in SQL:
                verdict = differences(got, con.execute(SQL[name]).df()) or "ok"
        except Exception as e:  # noqa: BLE001
            t1, got, verdict = time.time(), [], f"ERROR {str(e)[:1500]}"
        failed += verdict not in ("ok", "rows-only")
        print(
            f"{name:40s} {len(got):7d} rows spark {t1 - t0:6.2f}s sql {time.time() - t1:6.2f}s "
            f"{verdict}",
            flush=True,
        )
    print("failed:", failed)


if __name__ == "__main__":
    main(*sys.argv[1:])
