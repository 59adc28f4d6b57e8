"""Range splits of equal row counts: on DuckDB and Spark SQL, no server."""

from __future__ import annotations

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from possum.sources.splits import equal_predicates, key_histogram, range_predicates, split_points


def _table(con, keys):
    con.execute("CREATE OR REPLACE TABLE t (id BIGINT)")
    if keys:
        con.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])
    return lambda sql: con.execute(sql).fetchall()


def _sizes(run, predicates):
    return [run(f"SELECT COUNT(*) FROM t WHERE {p}")[0][0] for p in predicates]


def test_skewed_ids_give_equal_splits():
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT range AS id FROM range(60000)"
                " UNION ALL SELECT 4000000000000 + range * 1000 FROM range(40000)"
                " UNION ALL SELECT 9000000000000000000 + range % 7 FROM range(20000) UNION ALL SELECT NULL")

    def run(sql):
        return con.execute(sql).fetchall()

    seen = []
    predicates = equal_predicates(lambda sql: seen.append(sql) or run(sql), "t", "id", 16)
    sizes = _sizes(run, predicates)
    assert len(predicates) >= 12 and sum(sizes) == 120_001
    assert max(sizes) <= 2 * 120_001 / 16 and min(sizes) * 2 >= 120_001 / 16 / 2
    assert len(seen) <= 10  # one query a round
    equal_width = [run(f"SELECT COUNT(*) FROM t WHERE id BETWEEN {k} * 562500000000000000 AND ({k} + 1) * 562500000000000000 - 1")[0][0]
                   for k in range(16)]
    assert max(equal_width) == 100_000


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-10**6, 10**6), st.integers(-2**62, 2**62)), max_size=60),
       st.integers(1, 9))
def test_every_row_is_in_one_split(keys, parts):
    run = _table(duckdb.connect(), keys)
    predicates = equal_predicates(run, "t", "id", parts)
    assert len(predicates) <= parts
    assert sum(_sizes(run, predicates)) == len(keys)
    both = " OR ".join(f"(({a}) AND ({b}))" for i, a in enumerate(predicates) for b in predicates[i + 1:])
    assert not both or run(f"SELECT COUNT(*) FROM t WHERE {both}")[0][0] == 0
    known = [k for k in keys if k is not None]
    histogram = key_histogram(run, "t", "id", parts)
    assert sum(n for _, _, n in histogram) == len(known)
    for a, b, n in histogram:
        assert n == sum(a <= k <= b for k in known) and (a == b or n * 4 * parts <= len(known))


def test_one_id_with_most_rows_is_alone():
    run = _table(duckdb.connect(), [7] * 900 + list(range(100, 200)))
    sizes = _sizes(run, equal_predicates(run, "t", "id", 4))
    assert sizes[0] == 900 and sum(sizes) == 1000


def test_no_rows():
    assert range_predicates("id", []) == ["1 = 1"]
    assert split_points([], 8) == []
    assert equal_predicates(_table(duckdb.connect(), []), "t", "id", 8) == ["1 = 1"]
    assert equal_predicates(_table(duckdb.connect(), [None, None]), "t", "id", 8) == ["1 = 1"]


@pytest.mark.parametrize("parts", [1, 8])
def test_spark_sql_answers_the_same_queries(spark, parts):
    spark.range(20_000).selectExpr("CASE WHEN id % 4 = 0 THEN id * 100000007 ELSE id END AS id").createOrReplaceTempView("t")

    def run(sql):
        return [tuple(r) for r in spark.sql(sql).collect()]

    sizes = _sizes(run, equal_predicates(run, "t", "id", parts))
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / parts


def test_the_reader_gets_the_conditions(monkeypatch):
    """Without a database: what read_table asks for, and the ranges it reads by."""
    from possum.sources import jdbc
    con = duckdb.connect()
    con.execute('CREATE TABLE "SuppliersDocs" AS SELECT range * range AS "ID" FROM range(4000)')
    monkeypatch.setattr(jdbc, "_query", lambda spark, src, sql: con.execute(sql).fetchall())
    asked = {}

    class Asked(Exception):
        pass

    class Spark:
        class read:  # noqa: N801
            @staticmethod
            def format(name):
                return None

            @staticmethod
            def jdbc(url, table, properties, predicates):
                asked.update(url=url, table=table, properties=properties, predicates=predicates)
                raise Asked

    src = jdbc.JdbcBranch("b", "jdbc:sqlserver://db", user="u", password="p", equal_splits=True)
    with pytest.raises(Asked):
        jdbc.read_table(Spark, src, "suppliers_docs", 8)
    assert (asked["url"], asked["table"], asked["properties"]["user"]) == ("jdbc:sqlserver://db", "SuppliersDocs", "u")
    sizes = [con.execute(f'SELECT COUNT(*) FROM "SuppliersDocs" WHERE {p}').fetchone()[0] for p in asked["predicates"]]
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) <= 2 * 500
