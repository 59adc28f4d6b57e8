"""Operator 13: maximal periodic runs of words, by block convolution.

A run is a stretch of words with smallest period q and length of at least
``max(MIN_RUN, 2 q)`` that no neighbouring word extends. For a period q let the
scale B be the largest power of two with ``2 B - 1 + q`` not above that length:
then every run of period q holds an aligned block of B words together with the
block's copy q words on.

1. At every scale the blocks are compared with the windows that follow them, at
   all distances of the scale at once: the sums of squared differences are
   convolutions, computed exactly in the integers modulo a prime by a number
   theoretic transform over all blocks of a scale. Words are coded as random
   residues; a match is always zero, anything else is zero once in 2e9.
2. A zero is a seed (place, distance). It is extended to both sides word by
   word, which makes every result exact.
3. Seeds inside a known run whose period divides theirs belong to that run. Of
   runs over the same words the smallest period stays.

Blocks with a word that does not come again within the scale's distances can't
match and are not transformed; in prose that is nearly all of them. Scales above
``CAP`` words use blocks of CAP and several windows, so memory stays bounded for
a text of any length. Texts are read in bounded chunks; nothing is shuffled.

Nulls and odd input: a null or empty text has no words and no runs; a row
without id is never rewritten by ``planted``; repeated rows are judged row by
row; an empty table gives no rows. Columns other than id and text play no part.
Words are told apart by 64-bit hashes of their bytes (case counts).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.llm.tasks import arrow_map
from possum.llm.words import SPACED, U, chunks, hash_spans, mix, runs

MIN_RUN = 12
CAP = 1 << 14
CELLS = 1 << 18         # transformed numbers held at once
_P = U(2013265921)      # 15 * 2**27 + 1
_ROOT = 31              # a generator of its multiplicative group
_roots: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 to half - 1 of a root of unity of order 2 * half."""
    if (half, inverse) not in _roots:
        p = int(_P)
        w = pow(_ROOT, (p - 1) // (2 * half), p)
        if inverse:
            w = pow(w, -1, p)
        t = np.ones(1, np.uint64)
        while len(t) < half:    # double the table
            t = np.concatenate([t, t * U(pow(w, len(t), p)) % _P])
        _roots[half, inverse] = t
    return _roots[half, inverse]


def ntt(a: np.ndarray) -> np.ndarray:
    """Transform of each row (a power of two long), in bit-reversed order."""
    rows, n = a.shape
    half = n // 2
    while half:
        x = a.reshape(rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1]
        a = np.stack([(u + v) % _P, (u + _P - v) * _twiddles(half, False) % _P], 2).reshape(rows, n)
        half //= 2
    return a


def inverse_ntt(a: np.ndarray) -> np.ndarray:
    rows, n = a.shape
    half = 1
    while half < n:
        x = a.reshape(rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1] * _twiddles(half, True) % _P
        a = np.stack([(u + v) % _P, (u + _P - v) % _P], 2).reshape(rows, n)
        half *= 2
    return a * U(pow(n, -1, int(_P))) % _P


def zero_mismatches(code: np.ndarray, squares: np.ndarray, places: np.ndarray, block: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) where the block at a place stands again low to high words on.

    ``squares`` are the running sums of the squared codes; code must reach
    ``high + block`` words beyond the last place.
    """
    width = high - low + block
    n = 1 << (width - 1).bit_length()
    at, far = [], []
    for i in range(0, len(places), max(1, CELLS // n)):
        s = places[i:i + max(1, CELLS // n)]
        b = np.zeros((len(s), n), np.uint64)
        w = np.zeros((len(s), n), np.uint64)
        b[:, :block] = code[s[:, None] + np.arange(block)[::-1]]
        w[:, :width] = code[s[:, None] + low + np.arange(width)]
        cross = inverse_ntt(ntt(b) * ntt(w) % _P)[:, block - 1:width]
        q = np.arange(low, high + 1)
        copy = squares[s[:, None] + q + block] - squares[s[:, None] + q]
        own = squares[s + block] - squares[s]
        hit, d = np.nonzero((copy + own[:, None] + U(2) * (_P - cross)) % _P == 0)
        at.append(s[hit])
        far.append(d + low)
    return np.concatenate(at), np.concatenate(far)


def scales(longest: int, min_run: int, cap: int) -> Iterator[tuple[int, int, int]]:
    """(block, lowest, highest distance) over all periods 1 to longest."""
    def block(q: int) -> int:
        return min(cap, 1 << (((max(min_run, 2 * q) - q + 1) // 2).bit_length() - 1))

    q = 1
    while q <= longest:
        b = block(q)
        top = min(longest, q + 2 * b - 1)
        high = q
        while high < top and high < min_run and block(high + 1) == b:
            high += 1
        if high >= min_run:     # from here on a scale's periods are 2 B - 1 to 4 B - 2
            high = top if b == cap else min(top, 4 * b - 2)
        yield b, q, high
        q = high + 1


def _extend(words: np.ndarray, s: int, q: int) -> tuple[int, int]:
    """The places l to r around s where the words q apart are identical."""
    end, step, r = len(words) - q, 64, s
    while r < end:
        differ = words[r:min(r + step, end)] != words[r + q:min(r + step, end) + q]
        if differ.any():
            r += int(differ.argmax())
            break
        r, step = min(r + step, end), 2 * step
    step, l = 64, s
    while l > 0:
        a = max(0, l - step)
        differ = (words[a:l] != words[a + q:l + q])[::-1]
        if differ.any():
            l -= int(differ.argmax())
            break
        l, step = a, 2 * step
    return l, r


def _stretches(words: np.ndarray, q: int, seeds: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Maximal places l to r, at least ``need`` of them, with identical words q apart, that hold a seed."""
    if len(seeds) * 64 > len(words):    # many seeds: all places at once
        same = np.concatenate([[False], words[:-q] == words[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        l, r = edge[::2], edge[1::2]
        some = r - l >= need
        return list(zip(l[some].tolist(), r[some].tolist(), strict=True))
    out, i = [], 0
    while i < len(seeds):
        l, r = _extend(words, int(seeds[i]), q)
        if r - l >= need:
            out.append((l, r))
        i = max(i + 1, int(np.searchsorted(seeds, r)))
    return out


def _outside(known: dict[tuple[int, int], int], at: np.ndarray, far: np.ndarray, block: int) -> np.ndarray:
    """Which seeds (sorted by place) lie in no known run whose period divides their distance."""
    keep = np.ones(len(at), bool)
    for (start, length), p in known.items():
        if length >= 2 * block:
            i, j = np.searchsorted(at, [start, start + length])
            keep[i:j] &= ~((far[i:j] % p == 0) & (far[i:j] > p) & (at[i:j] + far[i:j] + block <= start + length))
    return keep


def find_runs(words: np.ndarray, longest: int, min_run: int = MIN_RUN, cap: int = CAP) -> np.ndarray:
    """Rows (start, length, period) of all runs with a period up to ``longest``.

    ``words`` are non-negative integers; no order among the rows.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    again = np.full(n, np.iinfo(np.int64).max)
    equal = words[order[1:]] == words[order[:-1]]
    again[order[:-1][equal]] = (order[1:] - order[:-1])[equal]
    pad = 4 * min(cap, max(n, min_run)) + min_run
    code = mix(np.concatenate([words.astype(np.uint64), U(1 << 62) + np.arange(pad, dtype=np.uint64)]) + U(1)) % _P
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * code % _P, dtype=np.uint64)])
    known: dict[tuple[int, int], int] = {}
    for block, low, high in scales(min(longest, n // 2), min_run, cap):
        whole = n // block
        # the block, its copy and the distance between them lie inside the text
        near = again[:whole * block].reshape(whole, block).max(axis=1) <= high
        places = np.flatnonzero(near) * block
        places = places[places + low + block <= n]
        if not len(places):
            continue
        at, far = zero_mismatches(code, squares, places, block, low, high)
        inside = at + far + block <= n
        at, far = at[inside], far[inside]
        left = _outside(known, at, far, block)
        at, far = at[left], far[left]
        for q in np.unique(far).tolist():
            need = max(min_run, 2 * q) - q
            for l, r in _stretches(words, q, at[far == q], need):
                known.setdefault((l, r - l + q), q)
    return np.array([(s, l, q) for (s, l), q in known.items()], np.int64).reshape(-1, 3)


def planted(doc_id, n: int) -> np.ndarray | None:
    """Word numbers of the contract's rewritten text; None if it stays as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _chunk(ids: list, data: np.ndarray, offs: np.ndarray, rewrite: Callable | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Number of runs per text, all runs by text, start and period, and the collapsed texts."""
    starts, ends = runs(SPACED[data].view(np.uint8), offs)
    first = np.searchsorted(starts, offs)
    count = np.diff(first)
    index = np.arange(len(starts))
    moved = np.zeros(len(ids), bool)
    for k, i in enumerate(ids):
        new = rewrite(i, int(count[k])) if rewrite else None
        if new is not None:
            index[first[k]:first[k + 1]] = first[k] + new
            moved[k] = True
    # one row of numbers for all texts, with a word of its own behind each
    _, number = np.unique(hash_spans(data, starts, ends), return_inverse=True)
    begin = first[:-1] + np.arange(len(ids))
    text = np.arange(len(starts) + len(ids)) + len(starts)
    text[np.arange(len(starts)) + np.repeat(np.arange(len(ids)), count)] = number[index]
    found = find_runs(text, int(count.max(initial=0)) // 2)
    doc = np.searchsorted(begin, found[:, 0], "right") - 1
    order = np.lexsort((found[:, 2], found[:, 0], doc))
    found, doc = found[order], doc[order]
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    found[:, 0] -= begin[doc]
    many = np.bincount(doc, minlength=len(ids))
    # untouched texts: their words and one blank behind each but the last
    inner = np.ones(len(starts), bool)
    inner[first[1:][count > 0] - 1] = False
    joined, use = data.copy(), SPACED[data]
    joined[ends[inner]] = 0x20
    use[ends[inner]] = True
    plain, cut = joined[use].tobytes(), np.concatenate([[0], np.cumsum(use)])[offs]
    raw, out = data.tobytes(), []
    for k in range(len(ids)):
        if moved[k] or many[k]:
            words = index[first[k]:first[k + 1]][kept[begin[k]:begin[k] + count[k]]]
            out.append(b" ".join([raw[a:b] for a, b in zip(starts[words].tolist(), ends[words].tolist(), strict=True)]).decode())
        else:
            out.append(plain[cut[k]:cut[k + 1]].decode())
    return many, found, out


def periodic_runs(docs: DataFrame, rewrite: Callable | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period by start and period) and
    collapsed: the words of which no run shows an earlier copy, joined by a blank.

    ``rewrite`` takes a row's id and its number of words and returns the numbers
    of the words to read instead, or None.
    """
    def task(batches):
        for b in batches:
            for i, j, data, offs in chunks(b.column(1)):
                ids = b.column(0).slice(i, j - i)
                many, found, collapsed = _chunk(ids.to_pylist(), data, offs, rewrite)
                rows = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([ids, lists, pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), task,
                     f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def run_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``periodic_runs`` rows."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("b"), lines.alias("lines"))
    length = -F.col("b.l")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("b.s").alias("start"), length.alias("length"), F.col("b.p").alias("period"),
        F.expr("(1000 * -b.l) div b.p").alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
