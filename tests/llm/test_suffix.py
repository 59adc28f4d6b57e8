from __future__ import annotations

import numpy as np
import pytest

from possum.llm import suffix
from tests.llm.brute import alnum, contaminated

ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short ITEM here"), (3, None), (4, "..."),
         (5, "one two three four five six seven eight nine ten"), (None, "nameless item of test words that is ten or more words long"),
         (2, "short ITEM here"), (6, "Ünï cödé wörds")]
TEXTS = [None, "", "...", "a short item, here. A short item here", "x one two three four five six seven eight nine ten y",
         "one two three four five six seven eight nine", "zero one TWO three four five six seven eight nine ten eleven twelve thirteen",
         "nameless item of test words that is ten or more words long", "ünï cödé wörds ÜNÏ cödé wörds",
         "pad " * 30_000 + "one two three four five six seven eight nine ten eleven", "short item here"]


def items_frame(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [1_000_000, 12])
def test_against_brute_force(spark, docs, block_words):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[4])]
    got = suffix.contamination(docs(rows), items_frame(spark), block_words=block_words).collect()
    want = contaminated([t for _, t in rows], ITEMS)
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got))) == \
        sorted(map(str, ((i, *w) for (i, _), w in zip(rows, want, strict=True))))


def test_removal_keeps_columns_and_clean_rows(spark, docs):
    table = docs(list(enumerate(TEXTS))).withColumnRenamed("n_chars", "n_hit")
    kept = suffix.decontaminate(table, items_frame(spark))
    assert kept.columns == table.columns
    clean = {k for k, w in enumerate(contaminated(TEXTS, ITEMS)) if not w[4]}
    assert {r.doc_id for r in kept.collect()} == clean


def test_longest_matches_are_the_longest_and_where_they_say(spark, docs):
    rows = [(9, "zz one two three four x"), (4, "two three four five six seven q"), (2, "a two three four five six seven")]
    got = suffix.longest_matches(docs(rows), items_frame(spark, ITEMS[:1])).collect()
    words = {i: alnum(t) for i, t in rows}
    item = alnum(ITEMS[0][1])

    def run(i, at, s):
        n = 0
        while at + n < len(words[i]) and s + n < len(item) and words[i][at + n] == item[s + n]:
            n += 1
        return n

    want = {}
    for s in range(len(item)):
        best = max((run(i, at, s), -i, -at) for i in words for at in range(len(words[i])))
        if best[0]:
            want[s] = (best[0], -best[1], -best[2])
    assert {r.suffix: (r.match_words, r.doc_id, r.doc_word) for r in got} == want


def test_suffix_array_order():
    rng = np.random.default_rng(0)
    ids = np.append(rng.integers(0, 4, 300), 0)
    sa = suffix.suffix_array(ids, 64)
    runs = [tuple(ids[p:p + list(ids[p:]).index(0)]) for p in sa]
    assert sorted(sa) == list(np.flatnonzero(ids)) and runs == sorted(runs)


def test_empty_tables(spark, docs):
    none = items_frame(spark, [(1, None)]).limit(0)
    assert suffix.contamination(docs([]), items_frame(spark)).collect() == []
    got = suffix.contamination(docs([(1, "one two")]), none).collect()[0]
    assert (got.n_words, got.n_hit, got.contaminated) == (2, 0, False)
    assert suffix.decontaminate(docs([(1, "one two")]), none).count() == 1
