"""Operator 9: language-model scores from a probabilistic suffix tree.

The tree's symbols are bytes: a text is its lower-cased words (A-Z only) joined
by one space, then an end symbol. A tree node is a context of up to ``DEPTH``
bytes. A context is a candidate from ``LEAST`` occurrences on, at every size of
the input, and is kept if its next-symbol distribution diverges from its
parent's (the context without its oldest byte) by at least ``GAIN`` nats over
its occurrences. Each distribution is smoothed with its parent's, in proportion
to the number of symbols seen; the root with one count for each byte. A symbol
is read from the longest kept context before it.

Like the base score, the model speaks of the words of the training part and of
unknown words, which the tree spells. With s the tree's probability of a word's bytes and of the symbol
after it, f the word's share of the training words, r the share of that symbol
(text goes on, or ends) and u the share of words seen once (the chance that
the next word is a new one):

    known word    (1 - u) * (SHARE * f * r + (1 - SHARE) * s)
    unknown word  u * s

A text without words is the end symbol.

All counting is done over the whole training part: packed byte strings of
``DEPTH + 1`` and word hashes are counted in every task and summed by key; the
byte strings of held-out texts are listed beside them, for they are to be
scored. The tree grows with the input and is never in one place: contexts of up
to ``NEAR`` bytes, a table of the corpus' byte triples, are fitted on the driver;
the byte strings are dealt out by the ``NEAR + 1`` bytes before their last, so
that a context meets its parent, and every byte string gets its probability
there. The most frequent byte strings, at most ``COMMON``, are sent along with
the texts; words that hold another one have it joined. The base score needs the
count of every word: words that make up at least 1 / ``COMMON`` of all tokens
are at most ``COMMON`` and are sent along; the others are joined by hash.

Nulls and odd input: a null text is empty and is one end symbol; a null id
belongs to the training part; repeated rows are scored one by one (rows are
told apart by a 64-bit key of id and text, and equal rows share their sums); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.llm.labelled import held_out
from possum.llm.staging import staged
from possum.llm.tasks import arrow_map
from possum.llm.words import LOWER, U, chunks, mix, split

DEPTH = 5
NEAR = 2
LEAST = 4
GAIN = 20.0
COMMON = 1 << 20
SHARE = 0.2
PIECE = 256
END, SPACE = 0x0A, 0x20
_FLUSH = 3_000_000


def symbols(data: np.ndarray, offs: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
    """The texts' byte symbols, each after DEPTH end symbols that start it.

    Also the position of each text's first symbol, and the total length.
    """
    n = np.diff(words.first)
    doc = np.repeat(np.arange(len(n)), n)
    length = words.ends - words.starts
    size = np.bincount(doc, weights=length + 1, minlength=len(n)).astype(np.int64) + (n == 0) + DEPTH
    begin = np.concatenate([[0], np.cumsum(size)])
    out = np.full(begin[-1], SPACE, np.uint8)
    for k in range(DEPTH):
        out[begin[:-1] + k] = END
    out[begin[1:] - 1] = END
    before = np.cumsum(length + 1) - (length + 1)
    at_first = before[words.first[:-1][n > 0]] if len(before) else before
    start = begin[doc] + DEPTH + before - np.repeat(at_first, n[n > 0])
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    source = np.arange(int(length.sum())) + np.repeat(words.starts - (np.cumsum(length) - length), length)
    out[np.arange(len(shift)) + shift] = LOWER[data[source]]
    return out, begin


def _predicted(begin: np.ndarray) -> np.ndarray:
    ok = np.ones(begin[-1], bool)
    for k in range(DEPTH):
        ok[begin[:-1] + k] = False
    return ok


def packed(stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Each text symbol with the DEPTH symbols before it, as one integer."""
    s = stream.astype(np.uint64)
    key = np.zeros(max(0, len(s) - DEPTH), np.uint64)
    for k in range(DEPTH + 1):
        key = (key << U(8)) | s[k:len(s) - DEPTH + k]
    return key[_predicted(begin)[DEPTH:]]


class _Counter:
    """Counts of uint64 keys, as sorted arrays."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        u, n = np.unique(keys, return_counts=True)
        self.parts.append((u, n))
        self.size += len(u)
        if self.size > _FLUSH:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        merged = keys[first], np.add.reduceat(n, first)
        self.parts, self.size = [merged], len(first)
        return merged

    def rows(self, kind: int):
        keys, n = self.merge()
        self.__init__()
        for at in range(0, len(keys), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys[part]), kind, np.int8)), pa.array(keys[part].view(np.int64)),
                 pa.array(n[part].astype(np.int64))], names=["kind", "key", "n"])


def corpus_counts(docs: DataFrame) -> DataFrame:
    """kind, key, n over text, held_out: 0 word hashes, 1 packed byte strings, 2 the number of texts of the
    training part; 3 packed byte strings of the other texts."""
    def task(batches):
        words, grams, others, texts = _Counter(), _Counter(), _Counter(), 0
        for b in batches:
            held = b.column(1)
            for i, j, data, offs in chunks(b.column(0).filter(pc.invert(held))):
                w = split(data, offs)
                words.add(w.hashes)
                grams.add(packed(*symbols(data, offs, w)))
                texts += j - i
            for _, _, data, offs in chunks(b.column(0).filter(held)):
                others.add(packed(*symbols(data, offs, split(data, offs))))
            for c, kind in ((words, 0), (grams, 1), (others, 3)):
                if c.size > _FLUSH // 2:  # many distinct keys: hand them over
                    yield from c.rows(kind)
        yield from words.rows(0)
        yield from grams.rows(1)
        yield from others.rows(3)
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int8()), pa.array([0]), pa.array([texts])], names=["kind", "key", "n"])

    rows = arrow_map(docs.select("text", "held_out"), task, "kind tinyint, key long, n long")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _level(k: int, keys: np.ndarray, n: np.ndarray, parent: np.ndarray, read: np.ndarray,
           least: int, gain: float) -> tuple[np.ndarray, np.ndarray]:
    """Of every key: the probability of its last symbol after the k before it, and after the longest kept context up to k.

    parent and read are the same of k - 1. All keys that end in the same k + 1
    symbols, or have the same k before the last, are among the keys.
    """
    if not len(keys):
        return parent, read
    ends, first, at = np.unique(keys & U((1 << 8 * (k + 1)) - 1), return_index=True, return_inverse=True)
    n = np.bincount(at, n, len(ends))
    up = parent[first]
    context = ends >> U(8)
    new = np.append(True, context[1:] != context[:-1])
    start, of = np.flatnonzero(new), np.cumsum(new) - 1
    total = np.add.reduceat(n, start)[of]
    kinds = np.add.reduceat((n > 0).astype(np.float64), start)[of]
    enough = total >= max(least, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        far = np.add.reduceat(np.where(n > 0, n * np.log(n / total / up), 0.0), start)[of]
        prob = np.where(enough, (n + kinds * up) / (total + kinds), up)
    return prob[at], np.where((enough & (far >= gain))[at], prob[at], read)


def gram_logs(counts: DataFrame, least: int = LEAST, gain: float = GAIN) -> DataFrame:
    """key, log10 probability of its last symbol, n in all texts: every packed byte string in ``corpus_counts``."""
    grams = counts.filter("kind IN (1, 3)")
    trained = F.when(F.col("kind") == 1, F.col("n")).otherwise(0)
    near = (grams.groupBy((F.col("key").bitwiseAND((1 << 8 * (NEAR + 1)) - 1)).alias("key"))
            .agg(F.sum(trained).alias("n")).toArrow())  # the byte triples of the texts
    low, n = near["key"].to_numpy().view(np.uint64), near["n"].to_numpy().astype(np.float64)
    order = np.argsort(low)
    low, n = low[order], n[order]
    symbol = np.bincount((low & U(255)).astype(np.int64), n, 256)
    prob = read = ((symbol + 1) / (symbol.sum() + 256))[(low & U(255)).astype(np.int64)]
    for k in range(1, NEAR + 1):
        prob, read = _level(k, low, n, prob, read, least, gain)
    shared = counts.sparkSession.sparkContext.broadcast((low, prob, read))

    def task(batches):
        parts = [tuple(b.column(c).to_numpy() for c in range(3)) for b in batches]
        if not parts:
            return
        kind, key, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys, at = np.unique(key.view(np.uint64), return_inverse=True)
        every = np.bincount(at, n, len(keys)).astype(np.int64)
        n = np.bincount(at, np.where(kind == 1, n, 0), len(keys))
        low, prob, read = shared.value
        at = np.searchsorted(low, keys & U((1 << 8 * (NEAR + 1)) - 1))
        prob, read = prob[at], read[at]
        for k in range(NEAR + 1, DEPTH + 1):
            prob, read = _level(k, keys, n, prob, read, least, gain)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.log10(read)), pa.array(every)],
                                         names=["key", "log", "n"])

    dealt = grams.select("kind", "key", "n").repartition(F.expr(f"(key >> 8) & {(1 << 8 * (NEAR + 1)) - 1}"))
    return arrow_map(dealt, task, "key long, log double, n long")


class _Lookup:
    """A hash table of uint64 keys below 2 ** 64 - 1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, U(0xFFFFFFFFFFFFFFFF))
        self.values = np.zeros(1 << self.bits, values.dtype)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] == U(0xFFFFFFFFFFFFFFFF)
            self.keys[at[free]] = keys[left[free]]
            mine = self.keys[at] == keys[left]
            self.values[at[mine]] = values[left[mine]]
            at, left = (at[~mine] + 1) & ((1 << self.bits) - 1), left[~mine]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys' values, 0 for others, and whether the table has them."""
        at = self._slot(keys)
        there = self.keys[at]
        found = there == keys
        out = np.where(found, self.values[at], 0)
        left = np.flatnonzero(~found & (there != U(0xFFFFFFFFFFFFFFFF)))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            there = self.keys[at]
            mine = there == keys[left]
            out[left[mine]], found[left[mine]] = self.values[at[mine]], True
            on = ~mine & (there != U(0xFFFFFFFFFFFFFFFF))
            at, left = at[on], left[on]
        return out, found


class SuffixTree:
    """A small tree in memory, as an automaton: for a state and a symbol, the log10 probability and the next state.

    It also keeps the contexts that kept ones are reached through.
    """

    def __init__(self, contexts: list[tuple[int, int, dict[int, int]]], gain: float = GAIN):
        """contexts: (length, packed context, next symbol -> count); the empty context is one of them."""
        nodes = {(k, c): nxt for k, c, nxt in contexts}
        root = nodes.get((0, 0), {})
        total = sum(root.values())
        seen = sorted(root)
        self.code = np.zeros(256, np.uint8)  # 0: a byte the training part does not have
        self.code[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        if len(seen) > 255:
            raise ValueError("more than 255 symbols")
        prob = {(0, 0): np.full(width, 1 / (total + 256))}
        for a, n in root.items():
            prob[0, 0][self.code[a]] = (n + 1) / (total + 256)
        keep = {(0, 0)}
        for k, c in sorted(nodes):
            if not k:
                continue
            parent = (k - 1, c & ((1 << 8 * (k - 1)) - 1))
            if parent not in prob:
                continue
            n = np.zeros(width)
            for a, x in nodes[k, c].items():
                n[self.code[a]] = x
            kinds, all_ = np.count_nonzero(n), n.sum()
            prob[k, c] = (n + kinds * prob[parent]) / (all_ + kinds)
            has = n > 0
            if float((n[has] * np.log(n[has] / all_ / prob[parent][has])).sum()) >= gain:
                keep.add((k, c))
        # a kept context needs its suffix (to fall back on) and its prefix (to be reached)
        for k in range(max((k for k, _ in keep), default=0), 0, -1):
            for c in [c for q, c in keep if q == k]:
                keep.add((k - 1, c & ((1 << 8 * (k - 1)) - 1)))
                if (k - 1, c >> 8) in prob:
                    keep.add((k - 1, c >> 8))
        kept = [(0, 0)]
        have = {(0, 0): 0}
        for k, c in sorted(keep - {(0, 0)}):
            if (k - 1, c >> 8) in have and (k - 1, c & ((1 << 8 * (k - 1)) - 1)) in have:
                have[k, c] = len(kept)
                kept.append((k, c))
        self.width, self.states = width, len(kept)
        self.log = np.log10(np.stack([prob[s] for s in kept])).astype(np.float32)
        self.move = np.zeros((len(kept), width), np.int32)
        for s, (k, c) in enumerate(kept):  # shorter contexts come first
            if k:
                self.move[s] = self.move[have[k - 1, c & ((1 << 8 * (k - 1)) - 1)]]
            for a in seen:
                t = have.get((k + 1, (c << 8) | a))
                if t is not None:
                    self.move[s, self.code[a]] = t

    def log_probs(self, stream: np.ndarray) -> np.ndarray:
        """log10 probability of every symbol after those before it; the first DEPTH are 0.

        The stream is cut into pieces that are read side by side: a state
        depends on the DEPTH symbols before it only.
        """
        n = len(stream) - DEPTH
        if n <= 0:
            return np.zeros(len(stream), np.float32)
        pieces = -(-n // PIECE)
        code = np.zeros(pieces * PIECE + DEPTH, np.uint8)
        code[:len(stream)] = self.code[stream]
        state = np.zeros(pieces, np.int64)
        out = np.empty((PIECE, pieces), np.float32)
        move, log = self.move.ravel(), self.log.ravel()
        at = np.arange(pieces) * PIECE
        for k in range(PIECE + DEPTH):
            cell = state * self.width + code[at + k]
            if k >= DEPTH:
                out[k - DEPTH] = log[cell]
            state = move[cell].astype(np.int64)
        return np.concatenate([np.zeros(DEPTH, np.float32), out.T.ravel()[:n]])


def frequent(grams: DataFrame) -> int:
    """The smallest count, a power of two, that at most ``COMMON`` byte strings reach."""
    size = F.length(F.bin("n")) - 1
    left = COMMON
    for k, many in sorted(grams.groupBy(size.alias("k")).count().collect(), reverse=True):  # 64 rows at most
        left -= many
        if left < 0:
            return 2 << k
    return 0


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: int = LEAST, gain: float = GAIN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("held_out", held_out(F.col("doc_id"), 7, 2))
    docs = docs.withColumn("id_key", F.xxhash64(F.col("doc_id").cast("string"), F.col("doc_id").isNull()))
    counts = staged(corpus_counts(docs), "counts")
    words = counts.filter("kind = 0")
    n_words, n_kinds, n_once, n_texts = (x or 0 for x in counts.agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))), F.count(F.when(F.col("kind") == 0, 1)),
        F.count(F.when((F.col("kind") == 0) & (F.col("n") == 1), 1)),
        F.sum(F.when(F.col("kind") == 2, F.col("n")))).first())
    all_tokens, kinds = n_words + n_texts, n_kinds + (n_texts > 0)
    new = (n_once + 1) / (n_words + 2)
    last = (n_texts + 1) / (n_words + n_texts + 2)
    is_common = F.col("n") * COMMON >= F.lit(n_words)
    common = words.filter(is_common).select("key", "n").toArrow()  # COMMON rows at most
    keys = common["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    grams = staged(gram_logs(counts, least, gain), "grams")
    often = frequent(grams)
    sent = grams.filter(F.col("n") >= often).select("key", "log").toArrow()  # COMMON rows at most
    shared = spark.sparkContext.broadcast((keys[order], common["n"].to_numpy()[order],
                                           _Lookup(sent["key"].to_numpy().view(np.uint64), sent["log"].to_numpy())))
    end_log = float(np.log10(n_texts + 1.0))

    def look_up(hashes):
        keys = shared.value[0]
        if not len(keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        return at, keys[at] == hashes

    def row_key(w, id_key):
        """A 64-bit key of id and words, and each word's text."""
        n = np.diff(w.first)
        place = np.arange(len(w.hashes)) - np.repeat(w.first[:-1], n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(w.hashes + place.astype(np.uint64)), dtype=np.uint64)])
        texts = total[w.first[1:]] - total[w.first[:-1]]
        return mix(mix(texts) + id_key.view(np.uint64)).view(np.int64)

    def tokens(data, offs):
        """Words, and for each stop, a word's or that of a text without words: the text, the place among the words
        (-1), the log10 probability of the byte strings sent along, whether it ends its text, and its other byte
        strings, with their bounds."""
        w = split(data, offs)
        stream, begin = symbols(data, offs, w)
        key = packed(stream, begin)
        lp, found = shared.value[2].get(key)
        last_byte = key & U(255)
        stop = np.flatnonzero((last_byte == SPACE) | (last_byte == END))
        spelled = np.diff(np.cumsum(lp)[stop], prepend=0.0)
        n = np.diff(w.first)
        doc = np.repeat(np.arange(len(n)), np.maximum(n, 1))
        bare = n[doc] == 0
        word = np.where(bare, -1, np.cumsum(~bare) - 1)
        other = np.flatnonzero(~found)
        bounds = np.concatenate([np.zeros(1, np.int64), np.searchsorted(other, stop, "right")])
        return w, doc, word, spelled, last_byte[stop] == END, key[other], bounds

    def counted(w, word):
        """Of each stop, the word's count if it was sent along, else 0."""
        at, known = look_up(w.hashes)
        n = np.where(known, shared.value[1][at] if len(shared.value[1]) else 0, 0)
        return known, n, (np.append(n, 0)[word], np.append(known, False)[word])

    texts = ("doc_id", "held_out", "row_key", "n_tokens", "known", "part", "score")
    types = (None, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
             pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.list_(pa.int64()))
    stops = ("stop", "key", "sent", "spelled", "ends", "grams")

    def score(batches):
        """A row for each text, then rows for its stops that are not done: those whose word or some of whose byte
        strings were not sent along."""
        from pyspark import TaskContext
        done = TaskContext.get().partitionId() << 40  # numbers the stops

        def batch(id_type, cols):
            size = len(next(iter(cols.values())))
            kinds = (id_type, *types[1:])
            return pa.RecordBatch.from_arrays(
                [cols[c] if isinstance(cols.get(c), pa.Array) else pa.array(cols[c], t) if c in cols else pa.nulls(size, t)
                 for c, t in zip((*texts, *stops), kinds, strict=True)], names=[*texts, *stops])

        for b in batches:
            id_key = b.column(3).to_numpy(zero_copy_only=False)
            for i, j, data, offs in chunks(b.column(1)):
                w, doc, word, spelled, ends, other, bounds = tokens(data, offs)
                known, n, (m, is_known) = counted(w, word)
                p = SHARE * m / max(n_words, 1) * np.where(ends, last, 1 - last) + (1 - SHARE) * 10.0 ** spelled
                lp = np.log10(np.where(is_known, (1 - new) * p, 1.0)) + np.where(is_known, 0.0, math.log10(new) + spelled)
                lp = np.where(word < 0, spelled, lp)
                is_partial = bounds[1:] > bounds[:-1]
                lp[is_partial] = 0.0  # put right below, like words that were not sent along

                def per_text(x, first=w.first):
                    return np.diff(np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])[first])

                keys = row_key(w, id_key[i:j])
                yield batch(b.column(0).type, {
                    "doc_id": b.column(0).slice(i, j - i), "held_out": b.column(2).slice(i, j - i), "row_key": keys,
                    "n_tokens": np.diff(w.first) + 1, "known": per_text(known.astype(np.int64)),
                    "part": per_text(np.log10(n + 1.0)), "score": np.bincount(doc, lp, j - i)})
                at = np.flatnonzero(is_partial | (~is_known & (word >= 0)))
                if len(at):
                    size = np.diff(bounds)[at]
                    yield batch(b.column(0).type, {
                        "row_key": keys[doc[at]], "stop": np.arange(done, done + len(at)),
                        "key": np.append(w.hashes, U(0)).view(np.int64)[word[at]],
                        "sent": np.where(word[at] < 0, -1, np.where(is_known[at], m[at], 0)),
                        "spelled": spelled[at], "ends": ends[at],
                        "grams": pa.ListArray.from_arrays(np.append(0, np.cumsum(size)).astype(np.int32),
                                                          pa.array(other[:bounds[-1]].view(np.int64)))})
                    done += len(at)

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = staged(arrow_map(docs, score, f"doc_id {kind}, held_out boolean, row_key long, n_tokens long, known long, part double, "
                                         "score double, stop long, key long, sent long, spelled double, ends boolean, "
                                         "grams array<long>"), "scored")
    rows, open_stops = read.filter("stop IS NULL").select(*texts), read.filter("stop IS NOT NULL")
    rare = words.filter(~is_common).select("key", "n")
    r = F.when(F.col("ends"), F.lit(last)).otherwise(F.lit(1 - last))

    def known(n):
        return F.log10((1 - new) * (SHARE * n / max(n_words, 1) * r + (1 - SHARE) * F.pow(F.lit(10.0), F.col("spelled"))))

    # words that were not sent along count as unknown above: those the training part has are put right here
    unknown = math.log10(new) + F.col("spelled")
    whole = open_stops.filter("size(grams) = 0").select("key", "row_key", "spelled", "ends")
    fixed = whole.join(rare, "key").select("row_key", "n", (known(F.col("n")) - unknown).alias("more_score"))
    if often:  # stops with byte strings that were not sent along count 0 above
        kept = ("stop", "sent", "key", "row_key", "spelled", "ends")
        stops = (open_stops.select(*kept, F.explode("grams").alias("gram"))
                 .join(grams.select(F.col("key").alias("gram"), "log"), "gram").groupBy("stop")
                 .agg(*[F.first(c).alias(c) for c in ("sent", "key", "row_key", "ends")],
                      (F.first("spelled") + F.sum("log")).alias("spelled")))
        # only words that were not sent along are looked up; the others are spread over the tasks
        stops = stops.withColumn("key", F.when(F.col("sent") == 0, F.col("key")).otherwise(F.xxhash64("stop")))
        stops = stops.join(rare, "key", "left").withColumn("n", F.when(F.col("sent") == 0, F.col("n")))
        fixed = fixed.unionByName(stops.select(
            "row_key", "n", F.when(F.col("sent") < 0, F.col("spelled")).when(F.col("sent") > 0, known(F.col("sent")))
            .when(F.col("n").isNotNull(), known(F.col("n"))).otherwise(unknown).alias("more_score")))
    sums = fixed.groupBy("row_key").agg(F.count("n").alias("more_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("more"),
                                        F.sum("more_score").alias("more_score"))
    same = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("same"))
    per = same.join(sums, "row_key").select(
        "row_key", (F.col("more_known") / F.col("same")).cast("long").alias("more_known"),
        (F.col("more") / F.col("same")).alias("more"), (F.col("more_score") / F.col("same")).alias("more_score"))
    floor = float(np.log10(all_tokens + kinds + 1.0))
    return rows.join(per, "row_key", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(int(n_texts > 0))).cast("long").alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
