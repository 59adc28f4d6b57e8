"""Every query with SQL against DuckDB, and every query's columns."""

from __future__ import annotations

import pytest

from possum.llm.oracle import ORACLES
from possum.llm.queries import QUERIES
from possum_checks.compare import _rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rel = duck.execute(ORACLES[name])
    want = _rows([c[0] for c in rel.description], rel.fetchall())
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
