"""The canonical views reproduce the row counts FIXTURES.md section 2 lists."""

from __future__ import annotations

import pytest

from possum.sources.adapters import canonical_views
from possum.sources.fixtures import RAW_TABLES

from conftest import SF_SMALL

# fixed values: FIXTURES.md section 2 (sf0.001, sf0.01)
ROWS = {
    "item_store": (1905, 32146),
    "pos_transaction": (1500, 15000),
    "transaction_entry": (6000, 60000),
    "suppliers_docs": (4951, 58785),
    "tentry_discount": (5710, 57059),
    "presence_view": (401, 4038),
}


@pytest.mark.parametrize("sf, col", [("0.001", 0), ("0.01", 1)])
def test_view_row_counts(spark, sf, col):
    views = canonical_views(spark, f"/root/testdata/sf{sf}")
    got = {name: views[name].count() for name in ROWS}
    assert got == {name: counts[col] for name, counts in ROWS.items()}


def test_coverage_counts_sf001(spark):
    from pyspark.sql import functions as F
    v = canonical_views(spark, "/root/testdata/sf0.01")
    ist = v["item_store"]
    assert ist.where(F.col("OnHand") > 0).count() == 11803
    assert ist.where(F.coalesce(F.col("OnHand"), F.lit(0)) == 0).count() == 8564
    assert ist.where(F.col("OnHand") < 0).count() == 11779
    te = v["transaction_entry"]
    assert te.where((F.col("TransactionEntryType") == 18) & (F.col("Total") < 0) & (F.col("Status") > -1)).count() == 9742
    t = v["pos_transaction"]
    as_of = F.expr("TIMESTAMP_NTZ '2001-08-01 12:00:00'")
    assert t.where(F.col("SaleTime") >= as_of - F.expr("INTERVAL 13 MONTH")).count() == 2484
    assert t.where(F.col("SaleTime") >= as_of - F.expr("INTERVAL 90 DAY")).count() == 572


@pytest.mark.parametrize("name", ["promotion_redemptions", "promotion_matrix", "salted_redemptions"])
def test_large_order_keys(spark, tmp_path, name):
    """Line ids stay unique and in range for order keys of 6,000,000 and far beyond."""
    import duckdb

    from possum_checks.compare import _rows
    from possum_checks.oracle_sql import ORACLES
    from possum_checks.queries import QUERIES
    con = duckdb.connect()
    for t in RAW_TABLES:
        shift = {"orders": "REPLACE (CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 6000000 ELSE o_orderkey + 600000000000 END AS o_orderkey)",
                 "lineitem": "REPLACE (CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey + 6000000 ELSE l_orderkey + 600000000000 END AS l_orderkey)"}.get(t, "")
        con.execute(f"COPY (SELECT * {shift} FROM read_parquet('{SF_SMALL}/{t}.parquet')) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    df = QUERIES[name](spark, str(tmp_path))
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLES[name])
    assert got[1] and got == _rows([c[0] for c in rel.description], rel.fetchall())


def test_line_ids_are_unique(spark, fixture_bundle):
    te = fixture_bundle["transaction_entry"]
    assert te.select("TransactionEntryID").distinct().count() == te.count()
