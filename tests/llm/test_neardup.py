from __future__ import annotations

import numpy as np
import pytest

from possum.llm import neardup
from tests.llm.brute import components


def near_copies(rng, words, n, most):
    """Copies of one text with up to ``most`` words changed, so links form chains and single texts."""
    base = [f"w{rng.integers(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for k in rng.choice(words, rng.integers(0, most + 1), replace=False):
            text[k] = f"x{rng.integers(1_000_000)}"
        out.append(" ".join(text))
    return out


def got(spark, docs, rows):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs(rows)).collect())


def want(rows):
    return [(i, n, c, i == c) for i, n, c in components(rows)]


@pytest.mark.parametrize(("block", "items"), [(2048, 1 << 19), (16, 1 << 19), (16, 300), (2048, 300)])
def test_groups_against_all_pairs(spark, docs, monkeypatch, block, items):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "CHUNK_ITEMS", items)
    rng = np.random.default_rng(5)
    texts = near_copies(rng, 60, 60, 5) + near_copies(rng, 150, 60, 14) + near_copies(rng, 30, 25, 3)
    passage = " ".join(f"p{k}" for k in range(40))  # one passage that many texts share
    texts += [passage + " " + " ".join(f"q{rng.integers(10_000)}" for _ in range(rng.integers(3, 40))) for _ in range(60)]
    texts += ["Same  text", "same text", "same\ttext ", "one", "ONE", "", "a b c d", "a b c d e", "a b c d e f g"] + [texts[0]] * 30
    order = rng.permutation(len(texts))
    rows = [(int(i) * 3, texts[k]) for i, k in enumerate(order)]
    assert got(spark, docs, rows) == want(rows)


def test_documents(spark, sf_dir, docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(spark, docs, rows) == want(rows)


def test_odd_rows(spark, docs):
    long = " ".join(f"w{k}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (9, "a b c"), (7, "A b\tC"), (7, "A b\tC"), (None, "a b c"), (None, None),
            (4, long), (5, long + " more"), (6, "other words here")]
    out = [tuple(r) for r in neardup.near_duplicates(docs(rows)).collect()]
    assert sorted(out, key=str) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (9, 1, 7, False), (7, 1, 7, True), (7, 1, 7, True), (None, 1, None, True),
        (None, 0, None, True), (4, 19_996, 4, True), (5, 19_997, 4, False), (6, 1, 6, True)], key=str)
    assert neardup.near_duplicates(docs([])).collect() == []


def test_deduplicate_keeps_columns_and_null_ids(spark, docs):
    table = docs([(2, "a b c d e f"), (1, "A B c d e f"), (None, "a b c d e f"), (3, "x")]).withColumnRenamed("lang", "kept")
    out = neardup.deduplicate(table)
    assert out.columns == table.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"]


def test_connected(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    got = {r.id: r.label for r in neardup.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 1, 200: 200, 201: 200, 300: 300}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    common = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 500, dtype=np.uint64)])) for _ in range(2))
    sig = neardup.signatures([a, b])
    assert abs((sig[0] == sig[1]).mean() - 0.75) < 0.17


def test_bound_never_excludes_what_is_shared():
    rng = np.random.default_rng(4)
    core = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(core, 150 + k, replace=False), rng.integers(0, 50, 20).astype(np.uint64)])) for k in range(40)]
    core = np.sort(core)
    shared = np.array([len(np.intersect1d(core, s)) for s in sets])
    out = np.stack([np.frombuffer(neardup._marks(np.setdiff1d(s, core)), np.uint64) for s in sets])
    gone = np.stack([np.frombuffer(neardup._marks(np.setdiff1d(core, s)), np.uint64) for s in sets])
    n = np.array([len(s) for s in sets])
    for i in range(40):
        most = neardup._most_shared(n, 200, i, np.arange(40), shared, out, gone)
        assert all(m >= len(np.intersect1d(sets[i], s)) for m, s in zip(most, sets, strict=True))


def just_unlinked(n, seed=6):
    """Copies of one text, each with enough changed words that few are linked."""
    return list(enumerate(near_copies(np.random.default_rng(seed), 200, n, 16)))


@pytest.mark.parametrize("n", [100, 400])
def test_an_unlinked_group_puts_out_no_pairs(spark, docs, monkeypatch, n):
    made = {}
    was = neardup.staged

    def counted(df, name):
        out = was(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "staged", counted)
    rows = just_unlinked(n)
    assert got(spark, docs, rows) == want(rows)
    assert made["open"] <= neardup.PREFIX * n and made["links"] <= neardup.PREFIX * n


def test_cells_compare_every_pair_once():
    """Whatever the chunks and blocks, each pair that the list compares meets in one cell."""
    rng = np.random.default_rng(9)
    for two in (False, True):
        cls, n = np.arange(30), rng.integers(1, 60, 30)
        side = rng.integers(0, 2, 30) if two else np.full(30, 2)
        old, neardup.CHUNK_ITEMS = neardup.CHUNK_ITEMS, 200
        try:
            rows = neardup._cells(5, 0, cls, n, side, cls)
        finally:
            neardup.CHUNK_ITEMS = old
        met = []
        for cell in {tuple(r[2:4]) for r in rows.tolist()}:
            m = [r for r in rows.tolist() if tuple(r[2:4]) == cell]
            for i in range(len(m)):
                ok = neardup._meet(m[i][4], np.array([x[4] for x in m[i + 1:]], np.int64))
                met += [tuple(sorted((m[i][5], x[5]))) for x, y in zip(m[i + 1:], ok, strict=True) if y]
        want = [(i, j) for i in range(30) for j in range(i + 1, 30) if not two or side[i] != side[j]]
        assert sorted(met) == want


def test_deduplicate_keeps_one_row_of_each_group(spark):
    a, b, c = "a b c d e f g h i j k l m n o p q r s t", "other words of another text stand here", "third text with words of its own"
    rows = [(1, a, "x"), (1, a, "y"), (1, a, "x"), (1, b, "x"), (2, a + " u", "x"), (3, b, "x"), (4, None, "x"), (4, None, "x"),
            (5, "", "x"), (None, a, "x"), (None, a, "x"), (6, c, None), (6, c, None), (7, a.upper(), "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    got = sorted(map(tuple, neardup.deduplicate(table).collect()), key=str)
    assert got == sorted([(1, a, "x"), (1, b, "x"), (4, None, "x"), (4, None, "x"), (5, "", "x"), (None, a, "x"), (None, a, "x"),
                          (6, c, None)], key=str)
    assert neardup.deduplicate(table.limit(0)).collect() == []


def test_posted_members_leave_a_task_in_bounded_batches(spark, docs, monkeypatch):
    """However many blocks the pairs of a batch have, and with the same groups as all pairs give."""
    was = neardup.arrow_map

    def bounded(df, task, schema):
        if not str(schema).startswith("pair long, block long, cls long"):
            return was(df, task, schema)

        def watched(batches):
            for b in task(batches):
                assert b.num_rows <= 500 + 40, b.num_rows
                yield b
        return was(df, watched, schema)

    monkeypatch.setattr(neardup, "arrow_map", bounded)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "SIGNED", 16, raising=False)
    monkeypatch.setattr(neardup, "POSTED", 500, raising=False)
    rng = np.random.default_rng(11)
    texts = near_copies(rng, 60, 50, 5) + [" ".join(f"y{rng.integers(10_000)}" for _ in range(20)) for _ in range(40)]
    rows = list(enumerate(texts))
    assert got(spark, docs, rows) == want(rows)


def test_middle_member_by_the_majority_of_sketch_bits():
    rng = np.random.default_rng(3)
    for m in (2, 3, 50):
        s = rng.integers(0, 1 << 63, m, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, m, dtype=np.uint64)
        cols = [np.zeros(m, np.int64), np.zeros(m, np.int64), np.arange(m), np.ones(m, np.int64), s.view(np.int64),
                np.full(m, 2, np.int8), np.zeros(m, np.int64)]
        (got,) = neardup._lists(cols, np.array([0]), np.array([m]))
        most = sum(1 << k for k in range(64) if 2 * sum(int(x) >> k & 1 for x in s) > m)
        far = [(int(x) ^ most).bit_count() for x in s]
        assert got.column(2)[0].as_py() == far.index(min(far))
