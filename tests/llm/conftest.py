from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) rows, with the table's other columns."""
    def make(rows, **other):
        full = [(i, t, other.get("lang", "en"), other.get("source", "s"), len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return make
