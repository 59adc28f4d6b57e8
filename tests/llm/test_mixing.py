from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from possum.llm import mixing
from tests.llm.brute import spaced


def targets(sizes, weights=(1, 2, 3), most=3):
    """Water filling, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        level = rest / free if free else 0
        over = {s for s in order if s not in capped and level * w[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * w[s] for s in order}
        capped |= over


def rows_of(spark, sf_dir):
    return [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def check(spark, rows):
    table = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, source string, text string, size int")
    got = mixing.mix(table).collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(spaced(t))
    want = targets(sizes)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        if sizes[r.source]:  # the whole part is certain, and no more than one copy is drawn
            assert -1e-9 <= r.copies - int(want[r.source] / sizes[r.source] + 1e-9) <= 1
    for s in sizes:
        longest = max(len(spaced(t)) for _, x, t in rows if x == s)
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], longest / 2)
    return got, table


def test_documents(spark, sf_dir):
    got, table = check(spark, rows_of(spark, sf_dir))
    again = mixing.mix(table.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_targets_stop_at_three_times_the_size(spark):
    rows = [(k, s, "w " * n) for s, n in (("a", 500), ("b", 3), ("c", 1), (None, 40), ("é", 2)) for k in range(20)]
    got, _ = check(spark, [(i, s, t) for i, (_, s, t) in enumerate(rows)])
    assert {r.copies for r in got if r.source == "c"} == {3}  # wholly certain copies


def test_odd_rows(spark):
    rows = [(None, None, None), (None, None, "a b"), (1, "x", ""), (2, "x", None), (3, "y", "one two three"), (3, "y", "one two three"),
            (4, "z", "w " * 20_000), (5, "z", "w"), (6, "", "q r s")]
    table = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, source string, text string, size int")
    got = mixing.mix(table).collect()
    assert len(got) == len(rows) and {r.size for r in got if r.source == "x"} == {0}
    assert len({r.copies for r in got if r.source == "y"}) == 1  # repeated rows are taken alike
    assert mixing.mix(table.limit(0)).collect() == []


def test_longer_documents_are_likelier(spark):
    rows = [(i, "a" if i % 2 else "b", "w " * (10 if i % 4 < 2 else 200)) for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = [r for r in mixing.mix(table, weights=(1, 3)).collect() if r.source == "a"]  # half of a's words
    share = {n: sum(r.copies for r in got if r.size == n) / sum(r.size == n for r in got) for n in (10, 200)}
    assert share[10] < 0.5 < share[200] + 0.02 and share[200] - share[10] > 0.1


def test_documents_of_the_mix(spark, docs):
    rows = [(i, "w " * (i % 9 + 1)) for i in range(300)]
    table = docs(rows).withColumnRenamed("lang", "odds")
    out = mixing.mixed_documents(table)
    plan = {r.doc_id: r for r in mixing.mix(table).collect()}
    got = out.collect()
    assert out.columns == [*table.columns, "copies", "taken"]
    assert {r.doc_id: (r.copies, r.taken) for r in got} == {i: (r.copies, r.taken) for i, r in plan.items() if r.copies}


def test_plan_is_native(spark, docs):
    text = mixing.mix(docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Arrow", "Pandas"))


def test_columns_named_like_the_plans(spark, docs):
    names = ("last", "target", "share", "rest", "whole", "size", "odds", "bin", "cut_bin", "closing", "source_size", "copies", "taken", "__s")
    table = docs([(i, "w " * (i % 9 + 1)) for i in range(60)])
    for k, c in enumerate(names):
        table = table.withColumn(c, F.lit(k))
    out = mixing.mixed_documents(table)
    rows = out.collect()
    assert out.columns == [c for c in table.columns if c not in ("copies", "taken")] + ["copies", "taken"]
    assert rows and all(r[c] == k for r in rows for k, c in enumerate(names) if c not in ("copies", "taken"))
