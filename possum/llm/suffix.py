"""Operator 4: benchmark decontamination with suffix arrays.

The training texts are dealt into shards of whole documents as Spark reads
them. A task turns the words of a shard into numbers (words that the test set
does not use are 0 and end a match), builds the shard's suffix array by prefix
doubling, and binary-searches every suffix of every test item in it, one word
deeper at a time and all suffixes at once. What comes out is, per test suffix,
its longest verbatim match with the places, and per document the words inside
any test window. Nothing is shuffled.

The test set is read in blocks of at most ``BLOCK_WORDS`` words, each sent to
the executors once; the blocks follow each other over the same rows, so a test
set of any size is searched whole. Words are told apart by 64-bit hashes.

Nulls and odd input: null or wordless texts and items have no windows; items
without id still mark words but are not listed; repeated items count once;
repeated documents are judged row by row; empty tables give empty results.
Columns of the documents other than id and text pass through ``decontaminate``
untouched, whatever their names (but for the prefix ``__sfx_``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm.tasks import arrow_map
from possum.llm.words import ALNUM, chunks, split

WINDOW = 10
SHARD_BYTES = 1 << 20
BLOCK_WORDS = 4_000_000  # 32 MB of hashes
_TEXT = "__sfx_text"
_FOUND = [T.StructField("__sfx_n_words", T.LongType()), T.StructField("__sfx_starts", T.ArrayType(T.IntegerType())),
          T.StructField("__sfx_ends", T.ArrayType(T.IntegerType())), T.StructField("__sfx_items", T.ArrayType(T.StringType()))]


class TestBlock:
    """Some test items as arrays: every suffix, and which window it starts."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        texts = sorted({(i, t) for i, t in items}, key=lambda x: (x[0] is None, x[0] or "", x[1] or ""))
        hashes, begins, lengths, owners, self.names = [], [], [], [], []
        at = 0
        for i, j, data, offs in chunks(pa.array([t for _, t in texts], pa.string())):
            w = split(data, offs, ALNUM)
            for r in range(j - i):
                words = w.hashes[w.first[r]:w.first[r + 1]]
                if len(words):
                    hashes += [words, np.zeros(1, np.uint64)]
                    begins.append(at + np.arange(len(words)))
                    lengths.append(len(words) - np.arange(len(words)))
                    owners.append(np.full(len(words), len(self.names)))
                    self.names.append(texts[i + r][0])
                    at += len(words) + 1
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(self.hashes[self.hashes != 0])
        ids = np.searchsorted(self.vocabulary, self.hashes) + 1
        self.ids = np.append(np.where(self.hashes != 0, ids, 0), 0).astype(np.int64)
        self.begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
        self.length = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        self.owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        del self.hashes
        # the window a suffix starts: its first words, or the whole of a shorter item
        first = np.zeros(len(self.begin), bool)
        first[np.flatnonzero(np.diff(self.owner, prepend=-1))] = True
        self.need = np.where(self.length >= window, window, np.where(first, self.length, 0))
        # suffixes that start the same window share its number
        seen: dict[bytes, int] = {}
        self.window = np.array([seen.setdefault(self.ids[b:b + n].tobytes(), len(seen)) if n else -1
                                for b, n in zip(self.begin, self.need)], np.int64)
        self.windows = len(seen)
        pairs = np.unique(np.stack([self.window, self.owner], 1)[self.need > 0], axis=0)
        self.item_of = pairs[:, 1]
        self.items_from = np.searchsorted(pairs[:, 0], np.arange(self.windows + 1))


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of non-zero ids in the order of what follows, to ``depth`` words.

    A 0 ends a suffix. Prefix doubling: ranks by 1, 2, 4 ... words.
    """
    n = len(ids)
    pos = np.flatnonzero(ids)
    if not len(pos):
        return pos
    ends = np.append(np.flatnonzero(ids == 0), n)
    left = ends[np.searchsorted(ends, pos)] - pos
    rank = np.zeros(n, np.int64)
    rank[pos] = ids[pos]
    order = np.argsort(rank[pos], kind="stable")
    k = 1
    while k < depth and (left > k).any():
        top = int(rank.max()) + 1
        after = np.where(left > k, rank[np.minimum(pos + k, n - 1)], 0)
        key = rank[pos] * top + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.cumsum(np.concatenate([[1], (key[1:] != key[:-1]).astype(np.int64)]))
        rank[pos[order]] = new
        if new[-1] == len(pos):
            break
        k *= 2
    return pos[order]


def _bound(values, lo: np.ndarray, hi: np.ndarray, want: np.ndarray) -> np.ndarray:
    """First index in [lo, hi) whose value is not below want, for all queries at once."""
    lo, hi = lo.copy(), hi.copy()
    open_ = lo < hi
    while open_.any():
        mid = (lo + hi) >> 1
        less = np.zeros(len(lo), bool)
        less[open_] = values(mid[open_], open_) < want[open_]
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
        open_ = lo < hi
    return lo


def search(ids: np.ndarray, sa: np.ndarray, test: TestBlock):
    """Per test suffix: longest match length, its range in sa, and its window's range.

    ``ids`` ends with at least one 0.
    """
    m = len(test.begin)
    best, best_lo, best_hi = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    win_lo, win_hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
    live = np.arange(m)
    lo, hi = np.zeros(m, np.int64), np.full(m, len(sa))
    d = 0
    while len(live):
        want = test.ids[test.begin[live] + d]
        values = lambda mid, _: ids[sa[mid] + d]  # noqa: E731,B023
        new_lo = _bound(values, lo, hi, want)
        new_hi = _bound(values, new_lo, hi, want + 1)
        d += 1
        ok = new_lo < new_hi
        live, lo, hi = live[ok], new_lo[ok], new_hi[ok]
        best[live], best_lo[live], best_hi[live] = d, lo, hi
        full = test.need[live] == d
        win_lo[live[full]], win_hi[live[full]] = lo[full], hi[full]
        more = test.length[live] > d
        live, lo, hi = live[more], lo[more], hi[more]
    return best, best_lo, best_hi, win_lo, win_hi


def _shards(texts: pa.Array, test: TestBlock) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j, their words as test ids with a 0 after each text, and the texts' first positions."""
    for i, j, data, offs in chunks(texts, SHARD_BYTES):
        w = split(data, offs, ALNUM)
        at = np.searchsorted(test.vocabulary, w.hashes)
        at[at == len(test.vocabulary)] = 0
        known = test.vocabulary[at] == w.hashes if len(test.vocabulary) else np.zeros(len(at), bool)
        doc = np.repeat(np.arange(j - i), np.diff(w.first))
        ids = np.zeros(len(at) + j - i + 1, np.int64)
        ids[np.arange(len(at)) + doc] = np.where(known, at + 1, 0)
        yield i, j, ids, w.first + np.arange(j - i + 1)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All indexes of the ranges, and which range each is from."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    return np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which], which


def _hits(texts: pa.Array, test: TestBlock, depth: int):
    """Per row: words, hit word ranges, and the items whose windows occur."""
    for i, j, ids, first in _shards(texts, test):
        rows = j - i
        n_words = np.diff(first) - 1
        sa = suffix_array(ids, depth)
        _, _, _, lo, hi = search(ids, sa, test)
        has = np.flatnonzero(hi > lo)
        _, one = np.unique(test.window[has], return_index=True)  # a window's range is the same for all its suffixes
        has = has[one]
        at, which = _ranges(lo[has], hi[has])
        pos = sa[at]
        mark = np.zeros(len(ids) + 1, np.int64)
        np.add.at(mark, pos, 1)
        np.add.at(mark, pos + test.need[has][which], -1)
        hit = np.cumsum(mark)[:len(ids)] > 0
        edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        doc_of = np.searchsorted(first, starts, "right") - 1
        span = np.searchsorted(doc_of, np.arange(rows + 1))
        pairs = np.unique(np.stack([np.searchsorted(first, pos, "right") - 1, test.window[has][which]], 1), axis=0) \
            if len(pos) else np.zeros((0, 2), np.int64)
        pair_at = np.searchsorted(pairs[:, 0], np.arange(rows + 1))
        for r in range(rows):
            wins = pairs[pair_at[r]:pair_at[r + 1], 1]
            owners = np.unique(np.concatenate([test.item_of[test.items_from[x]:test.items_from[x + 1]] for x in wins])) \
                if len(wins) else ()
            yield (int(n_words[r]), starts[span[r]:span[r + 1]] - first[r], ends[span[r]:span[r + 1]] - first[r],
                   {test.names[o] for o in owners} - {None})


def _union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open ranges."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def _blocks(items: DataFrame, window: int, block_words: int) -> Iterator[TestBlock]:
    words = F.coalesce(F.regexp_count(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")), F.lit(0))
    n = math.ceil((items.agg(F.sum(words)).first()[0] or 0) / block_words)
    part = F.pmod(F.xxhash64("text"), F.lit(max(n, 1)))
    for b in range(n):
        yield TestBlock([(r[0], r[1]) for r in items.filter(part == b).toLocalIterator()], window)


def find_windows(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All columns of docs, then __sfx_n_words, __sfx_starts, __sfx_ends, __sfx_items.

    The ranges are the document's hit words, disjoint and in order; the items
    are the ids, as strings, of test items with an occurring window.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_id_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    place = docs.columns.index(text_col)
    schema = T.StructType(docs.schema.fields + _FOUND)
    width = len(docs.columns)

    def run(test, depth: int):
        def task(batches):
            for b in batches:
                found = list(_hits(b.column(place), test.value, depth))
                if b.num_columns > width:  # an earlier block has been here
                    for k, (n, s, e, names) in enumerate(found):
                        old = [b.column(width + c)[k].as_py() for c in range(1, 4)]
                        if old[0]:
                            s, e = _union(np.concatenate([s, old[0]]).astype(int), np.concatenate([e, old[1]]).astype(int))
                        found[k] = (n, s, e, names | set(old[2]))
                yield pa.RecordBatch.from_arrays(
                    list(b.columns[:width]) + [
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([x[1] for x in found], pa.list_(pa.int32())),
                        pa.array([x[2] for x in found], pa.list_(pa.int32())),
                        pa.array([sorted(x[3]) for x in found], pa.list_(pa.string()))],
                    names=b.schema.names[:width] + ["__sfx_n_words", "__sfx_starts", "__sfx_ends", "__sfx_items"])
        return task

    out, any_block = docs, False
    for test in _blocks(items, window, block_words):
        depth = int(test.length.max(initial=1))
        out = arrow_map(out, run(spark.sparkContext.broadcast(test), depth), schema)
        any_block = True
    if not any_block:  # no test words at all
        out = arrow_map(docs, run(spark.sparkContext.broadcast(TestBlock([], window)), 1), schema)
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, longest_run."""
    found = find_windows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(_TEXT)), items, _TEXT, **kwargs)
    lengths = F.zip_with("__sfx_ends", "__sfx_starts", lambda e, s: (e - s).cast("long"))
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", F.col("__sfx_n_words").alias("n_words"), n_hit.alias("n_hit"),
                        F.size("__sfx_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("__sfx_items"), ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"),
                        F.coalesce(F.array_max(lengths), F.lit(0)).cast("long").alias("longest_run"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **kwargs) -> DataFrame:
    """docs without the documents that hold a window of a test item, all columns kept."""
    found = find_windows(docs, items, text_col, **kwargs)
    return found.filter(F.size("__sfx_starts") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def longest_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text",
                    min_words: int = 1, block_words: int = BLOCK_WORDS) -> DataFrame:
    """item_id, suffix, match_words, doc_id, doc_word: each test suffix's longest verbatim match.

    ``suffix`` is the word at which the suffix starts in its item. Ties go to
    the smallest doc_id (null first), then word. Suffixes that match fewer than
    ``min_words`` words have no row. item_id is a string.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_id_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"item_id string, suffix long, match_words long, doc_id {kind}, doc_word long"

    def run(test, depth):
        def task(batches):
            t = test.value
            start = np.searchsorted(t.owner, t.owner, "left")
            for b in batches:
                for i, j, ids, first in _shards(b.column(1), t):
                    sa = suffix_array(ids, depth)
                    best, lo, hi, _, _ = search(ids, sa, t)
                    has = np.flatnonzero(best >= min_words)
                    at, which = _ranges(lo[has], hi[has])
                    pos = sa[at]
                    row = np.searchsorted(first, pos, "right") - 1
                    order = np.lexsort((pos, row, which))  # the first place in each document
                    keep = order[np.append(True, (np.diff(which[order]) != 0) | (np.diff(row[order]) != 0))] if len(pos) else order
                    s = has[which[keep]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([t.names[o] for o in t.owner[s]], pa.string()),
                        pa.array(np.arange(len(t.owner))[s] - start[s]), pa.array(best[s]),
                        b.column(0).take(pa.array(i + row[keep])), pa.array(pos[keep] - first[row[keep]])],
                        names=["item_id", "suffix", "match_words", "doc_id", "doc_word"])
        return task

    parts = [arrow_map(docs, run(spark.sparkContext.broadcast(t), int(t.length.max(initial=1))), schema)
             for t in _blocks(items, WINDOW, block_words)]
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    best = F.min(F.struct((-F.col("match_words")).alias("m"), "doc_id", "doc_word")).alias("b")
    return out.groupBy("item_id", "suffix").agg(best).select(
        "item_id", "suffix", (-F.col("b.m")).alias("match_words"), "b.doc_id", "b.doc_word")
