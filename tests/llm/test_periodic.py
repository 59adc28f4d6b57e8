"""Periodic runs against a plain version."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from possum.llm import periodic
from possum.llm.queries import QUERIES


def brute_runs(w, min_run=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_run, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def brute(i, text, rewrite=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(i).encode())
    if rewrite and i is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = brute_runs(w)
    kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + m for s, m, q in found)]
    return found, " ".join(kept)


def digest(i, text):
    found, kept = brute(i, text)
    s, m, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (i, len(found), s, m, q, None if q is None else 1000 * m // q,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def words_of(rng, n):
    k = rng.choice([1, 2, 3, 5])
    w = []
    while len(w) < n:
        u = [rng.randrange(k) for _ in range(rng.randrange(1, 25))]
        w += (u * rng.randrange(1, 6))[:rng.randrange(1, 100)]
    return w[:n]


@pytest.mark.parametrize("cap", [1, 2, 4, 1 << 14])
def test_runs(cap):
    rng = random.Random(cap)
    for _ in range(300):
        w = words_of(rng, rng.randrange(90))
        m = rng.choice([2, 3, 5, 12])
        got = periodic.find_runs(np.array(w, np.int64), len(w) // 2, m, cap)
        assert sorted(map(tuple, got.tolist())) == brute_runs(w, m)


def test_transform_is_exact():
    """The transform's cyclic convolution equals the one of plain integers."""
    rng = np.random.default_rng(3)
    p = int(periodic._P)
    a, b = (rng.integers(0, p, (3, 16), dtype=np.uint64) for _ in range(2))
    got = periodic.inverse_ntt(periodic.ntt(a) * periodic.ntt(b) % periodic._P)
    for r in range(3):
        x, y = a[r].tolist(), b[r].tolist()
        assert got[r].tolist() == [sum(x[j] * y[(i - j) % 16] for j in range(16)) % p for i in range(16)]


def test_zero_mismatches():
    rng = random.Random(4)
    w = np.array([rng.randrange(2) for _ in range(400)])
    code = periodic.mix(w.astype(np.uint64) + np.uint64(1)) % periodic._P
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * code % periodic._P, dtype=np.uint64)])
    at, far = periodic.zero_mismatches(code, squares, np.arange(0, 300, 4), 4, 7, 14)
    want = {(s, q) for s in range(0, 300, 4) for q in range(7, 15) if (w[s:s + 4] == w[s + q:s + q + 4]).all()}
    assert set(zip(at.tolist(), far.tolist(), strict=True)) == want


def test_long_texts_of_few_words():
    """Neither one repeated word nor a long period makes the work quadratic."""
    assert periodic.find_runs(np.zeros(300_000, np.int64), 150_000).tolist() == [[0, 300_000, 1]]
    assert periodic.find_runs(np.arange(300_000) % 70_001, 150_000).tolist() == [[0, 300_000, 70_001]]


def odd_rows():
    rng = random.Random(13)
    rows = [(i, rng.choice([" ", "  ", "\n"]).join("abcdeé"[x] for x in words_of(rng, rng.randrange(200)))) for i in range(150)]
    rows += [(None, "x " * 40), (200, None), (201, ""), (202, " \t\n "), (203, "one"), (204, "A a " * 20), (205, "w" * 5000 + " v" * 30),
             (206, " ".join(f"w{k % 700}" for k in range(3000)))]
    return rows + rows[:5] + [(3, "another text of the same row id")]


def test_rows(spark, docs):
    rows = odd_rows()
    for rewrite in (None, periodic.planted):
        got = periodic.periodic_runs(docs(rows), rewrite).collect()
        key = lambda r: (str(r[0]), str(r[1]), r[2])
        assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(
            ((i, *brute(i, t, rewrite is not None)) for i, t in rows), key=key)


def test_query_digests(spark, docs, tmp_path):
    rows = odd_rows()
    docs(rows).selectExpr("doc_id", "'x' AS runs", "text", "1 AS start", "2 AS b", "3 AS lines").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((digest(i, t) for i, t in rows), key=str)


def test_no_rows(spark, docs):
    assert periodic.run_digest(periodic.periodic_runs(docs([]), periodic.planted)).collect() == []
