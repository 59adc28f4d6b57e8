"""Operator 5: quality classifier on random-indexing word vectors.

Every token has a sparse random index vector, made from its hash. Its context
vector is the sum of the index vectors of its neighbours, counted over all
documents (a fixed table of ``BUCKETS`` x ``DIM``). A document is the mean of
its tokens' context vectors, scaled to length 1, beside the mean of their index
vectors. A two-layer network on that, written in numpy, is trained on all
labelled rows outside the held-out fold (in shards: ``possum.llm.labelled``),
and a temperature fitted on rows the network did not see turns its logits into
probabilities.

Tokens are runs of word bytes or of signs. A word all in capitals and a word
that repeats the word before it stand as one token each, so the two habits
are visible whatever words they fall on.

Nulls and odd input: a null or empty text has a zero vector and still gets a
score; repeated rows are scored one by one; an empty table gives no rows.
Without labels of two classes the score is the share of good labels (0.5
without any). Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm.labelled import Adam, averages, blocks, classes, held_out, shards, sigmoid, temperature_of
from possum.llm.tasks import arrow_map
from possum.llm.words import ALNUM, LOWER, SPACED, U, chunks, hash_spans, mix, runs

BUCKETS = 1 << 14
DIM = 32
NONZERO = 2
WINDOW = 2
HIDDEN = 32
EPOCHS = 300
ROUND = 10  # epochs between two averages
THRESHOLD = 0.3
_CAPS, _REPEAT = U(1), U(2)

_KIND = np.where(ALNUM[LOWER], 1, np.where(SPACED, 2, 0)).astype(np.uint8)
_IS_UP = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_IS_LOW = (np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)


def index_vectors() -> np.ndarray:
    """BUCKETS x DIM, NONZERO entries of +-1 a row."""
    out = np.zeros((BUCKETS, DIM), np.float32)
    ids = np.arange(BUCKETS, dtype=np.uint64)
    for k in range(NONZERO):
        h = mix(ids * U(0x9E3779B97F4A7C15) + U(k + 1))
        out[np.arange(BUCKETS), (h % U(DIM)).astype(int)] += np.where(h >> U(40) & U(1), 1, -1)
    return out


def token_buckets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token of a chunk, and each text's first token (and the total)."""
    starts, ends = runs(_KIND[data], offs)
    h = hash_spans(LOWER[data], starts, ends)
    ups, lows = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_IS_UP, _IS_LOW))
    first = np.searchsorted(starts, offs)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    word = np.flatnonzero(_KIND[data[starts]] == 1)
    caps = (ups[ends] - ups[starts] >= 2) & (lows[ends] == lows[starts])
    same = word[1:][(h[word[1:]] == h[word[:-1]]) & (doc[word[1:]] == doc[word[:-1]])]
    h[caps] = _CAPS
    h[same] = _REPEAT
    return (h & U(BUCKETS - 1)).astype(np.int64), first


def context_counts(texts: pa.Array, index: np.ndarray, out: np.ndarray) -> None:
    """Add the neighbours' index vectors of every token to the rows of out."""
    at = np.argsort(-np.abs(index), axis=1, kind="stable")[:, :NONZERO]
    sign = np.take_along_axis(index, at, axis=1)
    for i, j, data, offs in chunks(texts):
        b, first = token_buckets(data, offs)
        doc = np.repeat(np.arange(j - i), np.diff(first))
        cells, weights = [], []
        for d in range(1, WINDOW + 1):
            ok = doc[d:] == doc[:-d]
            left, right = b[:-d][ok], b[d:][ok]
            for a, c in ((left, right), (right, left)):
                for k in range(NONZERO):
                    cells.append(a * DIM + at[c, k])
                    weights.append(sign[c, k])
        out += np.bincount(np.concatenate(cells), np.concatenate(weights), out.size).astype(np.int64)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The context vectors of all buckets, counted over the whole table."""
    names = [f"v{k}" for k in range(DIM)]

    def task(batches):
        index, total, any_row = index_vectors(), np.zeros(BUCKETS * DIM, np.int64), False
        for b in batches:
            context_counts(b.column(0), index, total)
            any_row = True
        if any_row:
            rows = total.reshape(BUCKETS, DIM)
            keep = np.flatnonzero(rows.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keep.astype(np.int32))] + [pa.array(rows[keep, k]) for k in range(DIM)], names=["bucket", *names])

    parts = arrow_map(docs.select("text"), task, "bucket int, " + ", ".join(f"{n} long" for n in names))
    sums = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # BUCKETS rows at most
    out = np.zeros((BUCKETS, DIM))
    out[sums["bucket"].to_numpy()] = np.stack([sums[n].to_numpy() for n in names], axis=1)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(size > 0, size, 1)).astype(np.float32)


def document_vectors(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row per text: the mean of its tokens' rows of ``vectors``; zeros for an empty text."""
    out = np.zeros((len(texts), vectors.shape[1]))
    for i, j, data, offs in chunks(texts):
        b, first = token_buckets(data, offs)
        for k in np.flatnonzero(np.diff(first)):
            out[i + k] = vectors.take(b[first[k]:first[k + 1]], axis=0).mean(axis=0, dtype=np.float64)
    return out


class Network:
    """x -> tanh layer -> logit / temperature -> probability."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        self.mean, self.scale, self.t = mean, scale, 1.0
        rng = np.random.default_rng(seed)
        n = len(mean)
        self.w1 = rng.normal(0, n ** -0.5, (n, HIDDEN)).astype(np.float32)
        self.w2 = rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(np.float32)
        self.b1, self.b2 = np.zeros(HIDDEN, np.float32), np.zeros(1, np.float32)

    def adam(self) -> Adam:
        return Adam([self.w1, self.b1, self.w2, self.b2], 0.01)

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def train(self, adam: Adam, x: np.ndarray, y: np.ndarray, epochs: int) -> None:
        x = ((x - self.mean) / self.scale).astype(np.float32)
        y = y.astype(np.float32)
        for _ in range(epochs):
            h = np.tanh(x @ self.w1 + self.b1)
            g = (sigmoid(h @ self.w2 + self.b2) - y) / len(y)
            back = np.outer(g, self.w2) * (1 - h * h)
            adam.step([x.T @ back + 1e-4 * self.w1, back.sum(axis=0), h.T @ g + 1e-4 * self.w2, np.array([g.sum()])])

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.t)


def _numbers(batches) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, y and left of a shard."""
    x, y, left = [], [], []
    for b in batches:
        x.append(b.column("x").flatten().to_numpy().reshape(b.num_rows, -1))
        y.append(b.column("y").to_numpy().astype(float))
        left.append(b.column("left").to_numpy(zero_copy_only=False))
    return (np.concatenate(x), np.concatenate(y), np.concatenate(left)) if y else (np.zeros((0, 2 * DIM)), np.zeros(0), np.zeros(0, bool))


def train(rows: DataFrame) -> Network:
    """A calibrated network from all rows of ``shards``: the numbers of the round with the least loss on the rows left out."""
    def moments(batches):
        x, _, _ = _numbers(batches)
        if len(x):
            yield blocks(0, np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]]))

    width = 2 * DIM
    total = averages(rows, moments)[1].ravel().astype(float)
    n = total[2 * width]
    mean = total[:width] / n
    net = Network(mean, np.sqrt(np.maximum(total[width:2 * width] / n - mean * mean, 0)) + 1e-6)
    state, best, kept = net.adam().state(), np.inf, None

    for r in range(EPOCHS // ROUND):
        def task(batches, state=state, t=r * ROUND):
            x, y, left = _numbers(batches)
            if not len(y):
                return
            adam = net.adam()
            adam.resume(state, t)
            p = np.clip(sigmoid(net.logits(x[left])), 1e-7, 1 - 1e-7)
            yield blocks(0, np.array([-(y[left] * np.log(p) + (1 - y[left]) * np.log(1 - p)).sum(), left.sum()]))
            if not left.all():
                net.train(adam, x[~left], y[~left], ROUND)
                yield blocks(1, adam.state())

        _, got = averages(rows, task)
        loss = got[0, 0] / got[0, 1] if got[0, 1] else 0.0  # of the numbers this round began with
        if loss < best or not got[0, 1]:
            best, kept = loss, state
        if len(got) == 1:  # no row to learn from
            break
        state = got[1:].ravel()[:len(state)]
    net.adam().resume(kept, 0)

    def left_out(batches):
        for b in batches:
            x, y, left = _numbers([b])
            yield pa.RecordBatch.from_arrays([pa.array(net.logits(x[left]).astype(float)), pa.array(y[left])], names=["z", "y"])

    net.t = temperature_of(arrow_map(rows, left_out, "z double, y double"))
    return net


class Constant:
    def __init__(self, p: float):
        self.p = p

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality"):
    """(token vectors, network) learnt from docs (doc_id, text) and labels (doc_id, label).

    Documents become vectors where they lie; only these are dealt out to the shards.
    """
    vectors = np.concatenate([context_vectors(docs), index_vectors()], axis=1)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def task(batches):
        for b in batches:
            x = document_vectors(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = shards(docs.select("doc_id", "text"), task, "x array<double>", labels, label_col)
    try:
        n, mean = classes(rows)
        return shared, train(rows) if n > 1 else Constant(mean if n else 0.5)
    finally:
        rows.unpersist()


def scored(docs: DataFrame, model, text_col: str = "text", column: str = "score") -> DataFrame:
    """All columns of docs, then the score of the whole text."""
    vectors, network = model
    place, width = docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def task(batches):
        for b in batches:
            s = network.score(document_vectors(b.column(place), vectors.value))
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(s)], names=[*b.schema.names[:width], column])

    return arrow_map(docs, task, schema)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = scored(docs, fit(docs, labels, label_col))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
