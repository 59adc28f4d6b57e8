"""Line dedup against a plain version, and the index under insertions and deletions."""

from __future__ import annotations

import random

import numpy as np
import pytest

from possum.llm import linededup as ld

from tests.llm.brute import UP

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, held=None):
    """(id, lines, dropped, text) for each row; ``held`` are the rows of the index."""
    def key(line):
        return line.strip(BLANKS).translate(UP)

    docs = {}
    for i, text in rows if held is None else held:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                docs.setdefault(key(line), set()).add(i)
    last = {k: max(d) for k, d in docs.items() if len(d) >= 3}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or i >= last.get(key(x), i)]
        out.append((i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r["__line_total"], r["__line_dropped"], r.text) for r in df.collect()), key=str)


def make(rng, ids):
    pool = [f"  Line number {k} of the common pool{'é' * (k % 3)}" for k in range(12)] + ["short", "", "é" * 20, "é" * 19, "É" * 20]
    return [(i, "\n".join(rng.choice(pool).upper() if rng.random() < 0.3 else rng.choice(pool) + rng.choice(["", "\r", "\t "])
                          for _ in range(rng.randint(0, 9)))) for i in ids]


def test_texts(spark, docs):
    rng = random.Random(12)
    rows = make(rng, range(80)) + [(None, "  Line number 1 of the common pooléx"), (81, None), (82, ""), (83, "\n\n"), (84, "only line here, and it is long")]
    rows += rows[:4] + [(5, "a second text of one document\nLine number 2 of the common pooléé")]
    rows += [(90, "\n".join(f"Line number {k % 12} of the common pool" for k in range(20_000)))]
    assert result(ld.deduplicate_lines(docs(rows))) == brute(rows)


def test_insertions_and_deletions_are_reversible(spark, docs):
    rng = random.Random(5)
    a, b, c = make(rng, range(0, 40)), make(rng, range(30, 60)), make(rng, range(60, 75))
    one = ld.build(docs(a))
    assert result(ld.clean(one, docs(a))) == brute(a)
    two = ld.insert(ld.insert(one, docs(b)), docs(c))
    every = a + b + c
    assert result(ld.clean(two, docs(every))) == brute(every)
    # taking documents back, among them the largest holders of their lines
    gone = set(range(50, 75)) | {1, 2, 999}
    left = [r for r in every if r[0] not in gone]
    three = ld.delete(two, spark.createDataFrame([(i,) for i in gone] + [(None,)], "doc_id long"))
    assert result(ld.clean(three, docs(left))) == brute(left)
    # the same index as one built of what is left: references, counts and fingerprints
    fresh = ld.build(docs(left))
    for name in ("refs", "counts"):
        x, y = getattr(three, name), getattr(fresh, name)
        assert sorted(map(tuple, x.select(y.columns).collect())) == sorted(map(tuple, y.collect()))
    marks = [np.sort(ld.Cuckoo.load(bytes(i.filters.collect()[0]["table"])).table.ravel()) for i in (three, fresh)]
    assert (marks[0] == marks[1]).all()
    # inserting again what is there changes nothing
    again = ld.insert(three, docs(left))
    assert sorted(map(tuple, again.counts.collect())) == sorted(map(tuple, three.counts.select(again.counts.columns).collect()))


def test_small_shards_and_heavy_keys(spark, docs, monkeypatch):
    """Several shards, filters that overflow, and a broadcast of some keys give the same rows."""
    rng = random.Random(6)
    rows = make(rng, range(60)) + [(100 + i, f"line {i % 30} that stands in three documents") for i in range(90)]
    monkeypatch.setattr(ld, "SHARD_KEYS", 4)
    monkeypatch.setattr(ld, "HEAVY", 30)
    monkeypatch.setattr(ld.Cuckoo.__init__, "__defaults__", (4,))
    index = ld.build(docs(rows))
    assert index.shards > 4
    assert result(ld.clean(index, docs(rows))) == brute(rows)
    more = [(500 + i, f"line {i % 60} that stands in further documents") for i in range(200)]
    bigger = ld.insert(index, docs(more))
    assert bigger.shards > index.shards     # made anew with more shards
    assert result(ld.clean(bigger, docs(rows + more))) == brute(rows + more)


def test_the_filters_turn_lines_away(spark, docs):
    rows = [(i, f"a line of its own, number {i}, in one document\nthis line stands in every document") for i in range(300)]
    index = ld.build(docs(rows))
    assert ld.probe(index, index.refs).count() < 330 and index.refs.count() == 600


def test_no_rows_ties_and_other_columns(spark, docs):
    empty = docs([])
    index = ld.build(empty)
    assert result(ld.clean(index, empty)) == []
    rows = [(i, "the very same text in all documents\nand x") for i in range(5)]
    assert result(ld.clean(ld.insert(index, docs(rows)), docs(rows))) == brute(rows)
    assert result(ld.clean(ld.delete(ld.build(docs(rows)), empty.select("doc_id")), docs(rows))) == brute(rows)
    named = docs(rows).selectExpr("1 AS k1", "doc_id", "'x' AS keys", "text", "2 AS n", "3 AS shard", "4 AS kind", "5 AS largest", "6 AS table")
    out = ld.deduplicate_lines(named)
    assert out.columns == [*named.columns, "__line_total", "__line_dropped"]
    assert result(out) == brute(rows) and {(r.k1, r.n, r.table) for r in out.collect()} == {(1, 2, 6)}


@pytest.mark.parametrize("n", [1, 50, 5000])
def test_cuckoo_filter(n):
    rng = np.random.default_rng(n)
    keys, other = (rng.integers(-1 << 63, (1 << 63) - 1, (2, k)) for k in (n, 20_000))
    c = ld.Cuckoo(1 << 12)
    c.add(*keys)
    c.add(*keys[:, :1])                     # one key twice
    assert not c.full and c.may_hold(*keys).all() and c.may_hold(*other).mean() < 0.01
    c.remove(*keys[:, :1])
    assert c.may_hold(*keys).all()
    c.remove(*keys)
    assert not c.table.any()
    c.add(*rng.integers(-1 << 63, (1 << 63) - 1, (2, 20_000)))
    assert c.full and ld.Cuckoo.load(c.dump()).may_hold(*other).all()
