"""Every registered dataset against its DuckDB oracle on the smallest fixtures."""

from __future__ import annotations

import math

import duckdb
import pytest

from possum_checks.oracle_sql import ORACLES
from possum_checks.queries import QUERIES
from possum.sources.fixtures import RAW_TABLES

from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = sorted((tuple(_norm(r[i]) for i in order) for r in records),
                  key=lambda r: tuple((x is None, str(x)) for x in r))
    return [cols[i] for i in order], rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.execute(ORACLES[name])
    d_cols, d_rows = _rows([c[0] for c in rel.description], rel.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
