"""Spelling variants against a plain all-pairs version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from possum.llm import spelling

from tests.llm.brute import UP


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def forms(vocabulary, times=10):
    out = {}
    for w, n in vocabulary.items():
        near = sorted((-m, v) for v, m in vocabulary.items() if one_edit(w, v))
        big = bool(near) and -near[0][0] >= times * n
        out[w] = [near[0][1] if big else None, n, len(near), -near[0][0] if big else None]
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def brute(rows):
    c = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "")):
            run = run.translate(UP)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += len(run) >= 7
    return forms({w: n for w, n in c.items() if n >= 2})


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_texts(spark, docs):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(5, 9))) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=200))) for i in range(60)]
    rows += [(7, "Abcdefgh abcdefgh, ABCDEFGH"), (None, "abcdefgh abcdefgx"), (3, None), (4, ""), (5, " 1 -- 2 "), (60, "x" * 5000 + " " + "x" * 5000),
             (61, "y" * 3000 + " " + "y" * 3000 + " " + "y" * 2999 + " " + "y" * 2999)]
    rows += rows[:3]
    got = result(spelling.spelling_variants(docs(rows)))
    assert got == brute(rows)
    assert any(r[1] for r in got)


def test_dense_vocabulary_and_chains(spark):
    rng = random.Random(1)
    v = {"".join(rng.choices("ab", k=rng.randint(7, 9))): rng.choice([2, 3, 25, 300, 4000, 50000]) for _ in range(300)}
    v |= {"abcdefg": 2, "abcdefgh": 21, "abcdefghi": 220, "abcdefghij": 2300, "abcdefghijk": 24000, "zbcdefg": 20, "abcdeffg": 20}
    df = spark.createDataFrame(list(v.items()), "word string, n long")
    got = result(spelling.variants(df))
    assert got == forms(v)
    roots = {r[0]: r[2] for r in got}
    assert roots["abcdefg"] == "abcdefghijk"


def test_neighbourhood_holds_every_edit():
    """Whatever the edit, the key of one word is among the neighbours of the other, and once."""
    rng = random.Random(2)
    for _ in range(200):
        w = "".join(rng.choices("abcdefgé", k=rng.randint(7, 12)))
        k = rng.randrange(len(w) + 1)
        edits = [w[:k] + rng.choice("abé") + w[k:], w[:k] + rng.choice("abcé") + w[k + 1:]] + ([w[:k] + w[k + 1:]] if len(w) > 7 else [])
        _, keys = spelling.neighbourhood(pa.array([w]))
        assert len(np.unique(keys)) == len(keys)
        for v in edits:
            _, own = spelling.reduced(pa.array([v]))
            assert set(own.tolist()) & set(keys.tolist())


def test_a_long_word_takes_linear_work():
    owner, keys = spelling.neighbourhood(pa.array(["a" * 100_000, "abcdefgh" * 10]))
    assert len(keys) < 12 * 100_200 and set(owner.tolist()) == {0, 1}


def test_no_rows_and_other_columns(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert result(spelling.spelling_variants(empty)) == []
    clash = docs([(2, "abcdefgh abcdefgh")]).selectExpr("doc_id", "text", "1 AS word", "2 AS n", "3 AS run", "'x' AS i", "'y' AS form")
    assert result(spelling.spelling_variants(clash)) == brute([(2, "abcdefgh abcdefgh")])


@pytest.mark.parametrize("text", ["É" * 8, "×÷×÷×÷×÷", "ÀÁÂÃÄÅÆ"])
def test_accented_letters_keep_their_case(spark, docs, text):
    rows = [(1, f"{text} {text}"), (2, text)]
    assert result(spelling.spelling_variants(docs(rows))) == brute(rows)
