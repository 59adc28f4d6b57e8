"""Operator 7: toxicity by a convolutional text classifier in numpy.

Words (lower-cased runs of word bytes) are hashed into ``BUCKETS`` embeddings
of ``DIM`` numbers; filters ``WIDTHS`` words wide run over the whole text, each
keeps its largest answer, and a logistic layer scores them. Only buckets seen
in at least ``MIN_DOCS`` training texts have an embedding; every other word is
the zero vector, so rare words can't speak for a class. Words are counted and the
network is trained on the whole texts of all labelled rows outside the held-out
fold (in shards: ``possum.llm.labelled``; an embedding is averaged over the
shards that moved it), and rows it did not see give the temperature of its
probabilities and a decision threshold for each language.

The language only picks the threshold of ``flagged``; it is no input of the
score, and neither are labels, source and id.

Nulls and odd input: a null or empty text has no words and still gets a score;
a null or unseen language takes the threshold 0.5; repeated rows are scored one
by one; an empty table gives no rows. Without labels of two classes the score
is the share of toxic labels (0 without any).
"""

from __future__ import annotations

from copy import deepcopy

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm.labelled import Adam, averages, blocks, classes, held_out, numbered, shards, sigmoid, temperature_of
from possum.llm.staging import staged
from possum.llm.tasks import arrow_map
from possum.llm.words import ALNUM, U, chunks, split

BUCKETS = 1 << 22
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # per width
MIN_DOCS = 3
TRAIN_WORDS = 4_000  # of a text that training holds at a time, besides its word buckets
EPOCHS = 8
BATCH = 64
TOXIC_WEIGHT = 2.0  # of a toxic row in training; the rarer class
THRESHOLDS = np.linspace(0.05, 0.95, 19)
LEAST = 5  # rows of either class that a threshold is chosen from


def word_buckets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = split(data, offs, ALNUM)
    return (w.hashes & U(BUCKETS - 1)).astype(np.int32), w.first


class Cnn:
    def __init__(self, known: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.known = known  # buckets with an embedding, in order; row 0 is the zero vector
        self.emb = np.concatenate([np.zeros((1, DIM)), rng.normal(0, 0.1, (len(known), DIM))]).astype(np.float32)
        self.conv = [rng.normal(0, (w * DIM) ** -0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.base = np.full(1, -2.0, np.float32)
        self.t = 1.0

    def table(self) -> np.ndarray:
        """Bucket -> embedding row, for scoring many words."""
        out = np.zeros(BUCKETS, np.int32)
        out[self.known] = np.arange(1, len(self.known) + 1)
        return out

    def answers(self, rows: np.ndarray) -> np.ndarray:
        """Position x filter, by width. A window may hang over the text's end, over zero vectors."""
        taps = np.concatenate([f[j] for f in self.conv for j in range(len(f))], axis=1)
        all_taps = self.emb[rows] @ taps
        out = np.empty((len(rows), len(self.bias)), np.float32)
        at = 0
        for k, w in enumerate(WIDTHS):
            a = out[:, k * FILTERS:(k + 1) * FILTERS]
            a[:] = all_taps[:, at:at + FILTERS]
            for j in range(1, w):
                a[:-j or None] += all_taps[j:, at + j * FILTERS:at + (j + 1) * FILTERS]
            at += w * FILTERS
        return out

    def best(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of each filter's largest answer in a text, ``TRAIN_WORDS`` places at a time; 0 without words."""
        where, top = np.zeros(len(self.bias), np.int64), np.full(len(self.bias), -np.inf, np.float32)
        for at in range(0, len(rows), TRAIN_WORDS):
            a = self.answers(rows[at:at + TRAIN_WORDS + max(WIDTHS) - 1])[:TRAIN_WORDS]
            i = a.argmax(axis=0)
            v = a[i, np.arange(len(top))]
            more = v > top
            where[more], top[more] = at + i[more], v[more]
        return where, top if len(rows) else np.zeros_like(top)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.base[0]

    def pooled(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest answers per text; 0 for a text without words."""
        n = np.diff(first)
        out = np.zeros((len(n), len(self.bias)), np.float32)
        gap = max(WIDTHS) - 1  # zero vectors after each text keep windows inside it
        shift = np.repeat(np.arange(len(n)) * gap, n)
        padded = np.zeros(len(rows) + gap * len(n), rows.dtype)
        padded[np.arange(len(rows)) + shift] = rows
        answers = self.answers(padded)
        for k in np.flatnonzero(n):
            at = first[k] + k * gap
            out[k] = answers[at:at + n[k]].max(axis=0)
        return out

    def score(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        out = np.zeros(len(texts))
        for i, j, data, offs in chunks(texts):
            b, first = word_buckets(data, offs)
            out[i:j] = sigmoid(self.logits(self.pooled(table[b], first)).astype(float) / self.t)
        return out

    def start(self, held: np.ndarray, toxic: np.ndarray, n: int, share: float) -> None:
        """Let the first number of an embedding be how far its word leans to a class.

        The lean is the log-damped z score of the texts of class 1 that hold it
        (held, toxic: texts by known bucket; share: of class 1 among all n), and
        one filter of each width starts by reading it; training goes on from there.
        """
        z = (toxic - held * share) / np.sqrt(held * share * (1 - share) + 1)
        self.emb[1:, 0] = np.sign(z) * np.log1p(np.abs(z)) if n else 0
        for w, f in zip(WIDTHS, self.conv, strict=True):
            f[:, :, 0] = 0
            f[:, 0, 0] = 1 / w
        self.bias[::FILTERS] = -1.5
        self.out[::FILTERS] = 1.0

    def adam(self) -> Adam:
        return Adam([*self.conv, self.bias, self.out, self.base], 0.01)

    def train(self, dense: Adam, seen: np.ndarray, docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
        """One step on a batch; docs: embedding rows of each text's words, seen: AdaGrad's sums. Returns the rows moved."""
        n_filters = len(self.bias)
        pooled = np.zeros((len(docs), n_filters), np.float32)
        where = np.zeros((len(docs), n_filters), np.int64)
        for k, d in enumerate(docs):
            where[k], pooled[k] = self.best(d)
        gap = max(WIDTHS)  # zero vectors after each text
        flat = np.concatenate([part for d in docs for part in (d, np.zeros(gap, d.dtype))])
        where += np.cumsum([0] + [len(d) + gap for d in docs[:-1]])[:, None]
        hidden = np.maximum(pooled + self.bias, 0)
        g = (sigmoid(hidden @ self.out + self.base[0]) - y).astype(np.float32) / len(docs)
        g *= np.where(y == 1, TOXIC_WEIGHT, 1).astype(np.float32)
        back = np.outer(g, self.out) * (hidden > 0)
        grads, touched, moves = [], [], []
        for w, f in enumerate(self.conv):
            part = slice(w * FILTERS, (w + 1) * FILTERS)
            gf = np.zeros_like(f)
            for j in range(f.shape[0]):
                rows = flat[where[:, part] + j]
                gf[j] = np.einsum("kf,kfd->df", back[:, part], self.emb[rows])
                touched.append(rows.ravel())
                moves.append((back[:, part, None] * f[j].T[None]).reshape(-1, DIM))
            grads.append(gf + 1e-4 * f)
        dense.step([*grads, back.sum(axis=0), hidden.T @ g + 1e-4 * self.out, np.array([g.sum()], np.float32)])
        rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
        move = np.zeros((len(rows), DIM), np.float32)
        np.add.at(move, inverse, np.concatenate(moves))
        move[rows == 0] = 0
        seen[rows] += move * move
        self.emb[rows] -= 0.1 * move / np.sqrt(seen[rows])
        return rows


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best F1; 0.5 if either class has fewer than 5 rows. Ties to the one nearest 0.5."""
    over = [(p >= t) for t in THRESHOLDS]
    return threshold_of([int(o.sum()) for o in over], [int((o & (y == 1)).sum()) for o in over], int(y.sum()), len(y))


def threshold_of(over: list[int], right: list[int], ones: int, n: int) -> float:
    """``best_threshold`` from the rows at or over each threshold, those of class 1 among them, and all."""
    if min(ones, n - ones) < LEAST:
        return 0.5
    f1 = [2 * r / max(1, o + ones) for o, r in zip(over, right, strict=True)]
    return float(min(zip(THRESHOLDS, f1, strict=True), key=lambda x: (-x[1], abs(x[0] - 0.5)))[0])


_CODEC = "zstd"


def packed(words: np.ndarray) -> bytes:
    return len(words).to_bytes(8, "little") + pa.compress(words.astype(np.int32).tobytes(), codec=_CODEC, asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], 4 * n, codec=_CODEC, asbytes=True), np.int32)


def labelled_words(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """``shards`` of the labelled rows of docs (doc_id, text, lang): lang and the packed buckets of all words of the text."""
    def task(batches):
        for b in batches:
            out = []
            for i, j, data, offs in chunks(b.column(1)):
                w, first = word_buckets(data, offs)
                out += [packed(w[first[k]:first[k + 1]]) for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)], names=["doc_id", "words", "lang"])

    return shards(docs.select("doc_id", "text", "lang"), task, "words binary, lang string", labels, label_col)


def word_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets that at least ``MIN_DOCS`` of all rows hold, in order; the rows to learn from that hold them; the labels of these added up."""
    def task(batches):
        n, held, toxic = (np.zeros(BUCKETS, np.int32) for _ in range(3))
        for b in batches:
            for blob, y, left in zip(b.column("words"), b.column("y").to_pylist(), b.column("left").to_pylist(), strict=True):
                u = np.unique(unpacked(blob.as_py()))
                n[u] += 1
                if not left:
                    held[u] += 1
                    toxic[u] += y
        keep = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(keep.astype(np.int32)), *[pa.array(a[keep].astype(np.int64)) for a in (n, held, toxic)]],
                                         names=["bucket", "n", "held", "toxic"])

    parts = arrow_map(rows, task, "bucket int, n long, held long, toxic long")
    sums = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "held", "toxic")]).filter(F.col("n") >= MIN_DOCS)
    got = sums.select("bucket", "held", "toxic").toArrow().sort_by("bucket")  # BUCKETS rows at most
    return tuple(got[c].to_numpy() for c in ("bucket", "held", "toxic"))


def train(rows: DataFrame, epochs: int = EPOCHS, seed: int = 7) -> Cnn:
    """A network from all rows of ``shards``; after each pass over them the shards' networks are averaged."""
    known, held, toxic = word_counts(rows)
    net = Cnn(known)
    n, share = rows.filter(~F.col("left")).agg(F.count(F.lit(1)), F.avg("y")).first()
    net.start(held, toxic, n, share or 0.0)
    seen, state, steps, words = np.full(net.emb.shape, 0.1, np.float32), net.adam().state(), 0, len(net.emb)
    for epoch in range(epochs):
        shared = rows.sparkSession.sparkContext.broadcast((net, seen, state, steps))

        def task(batches, shared=shared, epoch=epoch):
            blobs, y = [], []
            for b in batches:
                learn = ~b.column("left").to_numpy(zero_copy_only=False)
                blobs += [x.as_py() for x, k in zip(b.column("words"), learn, strict=True) if k]
                y.append(b.column("y").to_numpy().astype(float)[learn])
            if not blobs:
                return
            y = np.concatenate(y)
            net, seen, state, steps = deepcopy(shared.value)  # a worker keeps the value for its next task
            dense, table, moved = net.adam(), net.table(), np.zeros(words, bool)
            dense.resume(state, steps)
            order = np.random.default_rng([seed, epoch]).permutation(len(y))
            for at in range(0, len(order), BATCH):
                batch = order[at:at + BATCH]
                moved[net.train(dense, seen, [table[unpacked(blobs[d])] for d in batch], y[batch])] = True
            moved[0] = False
            at = np.flatnonzero(moved)
            if len(at):
                yield numbered(at, np.concatenate([net.emb[at], seen[at]], axis=1))
            yield blocks(words, np.concatenate([dense.state(), [dense.t]]))

        at, got = averages(rows, task)
        shared.destroy()  # its copies on the executors' disks too
        if not len(at):
            break
        own, rest = at < words, got[at >= words].ravel()
        net.emb[at[own]], seen[at[own]] = got[own, :DIM], got[own, DIM:]
        state, steps = rest[:len(state)], int(round(rest[len(state)]))
        net.adam().resume(state, steps)
    return net


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic"):
    """(network or None, share of toxic labels, thresholds by language); docs has doc_id, text and lang."""
    rows = labelled_words(docs, labels, label_col)
    try:
        n, share = classes(rows)
        if n < 2:
            return None, share, {}
        net = train(rows)

        def left_out(batches):
            table = net.table()
            for b in batches:
                kept = b.filter(b.column("left"))
                for at in range(0, kept.num_rows, BATCH):
                    part = kept.slice(at, BATCH)
                    docs = [table[unpacked(x.as_py())] for x in part.column("words")]
                    z = net.logits(np.stack([net.best(d)[1] for d in docs])).astype(float)
                    yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(z), part.column("y")], names=["lang", "z", "y"])

        logits = staged(arrow_map(rows, left_out, "lang string, z double, y int"), "logits")
    finally:
        rows.unpersist()
    net.t = temperature_of(logits)
    return net, share, thresholds(logits, net.t)


def thresholds(logits: DataFrame, t: float) -> dict[str, float]:
    """``best_threshold`` of each language; one with too few rows is not listed: 0.5."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z") / F.lit(t)))
    one = F.col("y") == 1

    def count(which: Column, name: str) -> Column:
        return F.sum(which.cast("long")).alias(name)

    sums = logits.filter("lang is not null and lang <> ''").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), count(one, "ones"), *[count(p >= F.lit(float(x)), f"over{k}") for k, x in enumerate(THRESHOLDS)],
        *[count((p >= F.lit(float(x))) & one, f"right{k}") for k, x in enumerate(THRESHOLDS)])
    enough = sums.filter((F.col("ones") >= LEAST) & (F.col("n") - F.col("ones") >= LEAST))
    at = range(len(THRESHOLDS))
    return {r["lang"]: threshold_of([r[f"over{k}"] for k in at], [r[f"right{k}"] for k in at], r["ones"], r["n"])
            for r in enough.orderBy("lang").collect()}


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", label_col: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, flagged.

    ``predicted`` is by ``threshold``, ``flagged`` by the language's own.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    net, share, by_lang = fit(docs, labels, label_col)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def task(batches):
        table = net.table() if net is not None else None
        for b in batches:
            s = net.score(b.column(1), table) if net is not None else np.full(b.num_rows, share)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(s)], names=["doc_id", "lang", "score"])

    own = F.lit(0.5)
    for lang, t in by_lang.items():
        own = F.when(F.col("lang") == lang, F.lit(t)).otherwise(own)
    return arrow_map(docs, task, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), (F.col("score") >= own).alias("flagged"))
