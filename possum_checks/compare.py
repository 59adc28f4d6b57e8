"""Run each registered dataset in Spark and its oracle in DuckDB; compare.

    python -m possum_checks.compare [sf_dir] [name ...]

Rows are compared as multisets after sorting columns by name; doubles are
compared after rounding to 6 decimals.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from possum_checks.oracle_sql import ORACLES
from possum_checks.queries import QUERIES
from possum.session import build_session
from possum.sources.fixtures import RAW_TABLES

EXTRA_RAW = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [cols[i] for i in order], sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session()
    con = duckdb.connect()
    for t in RAW_TABLES + EXTRA_RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in ORACLES:
            print(f"{name:34s} rows={len(s_rows):7d} spark={t1-t0:6.2f}s  (no oracle)")
            continue
        rel = con.execute(ORACLES[name])
        d_cols = [c[0] for c in rel.description]
        d_rows = rel.fetchall()
        sc, sr = _rows(s_cols, s_rows)
        dc, dr = _rows(d_cols, d_rows)
        ok = sc == dc and sr == dr
        bad += not ok
        print(f"{name:34s} rows={len(s_rows):7d}/{len(d_rows):7d} spark={t1-t0:6.2f}s "
              f"{'OK' if ok else 'MISMATCH'}")
        if not ok:
            if sc != dc:
                print("   columns", sc, "vs", dc)
            else:
                a, b = set(sr), set(dr)
                print("   spark-only", sorted(a - b, key=str)[:3])
                print("   oracle-only", sorted(b - a, key=str)[:3])
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
