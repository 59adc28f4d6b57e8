"""Shared parts of the trained classifiers: folds, shards of the labelled rows, averaging, calibration.

A model is trained on all labelled rows outside the held-out fold. They are
dealt by id into partitions (shards) that stay on the executors; in each round
every shard goes on from the same numbers with its own rows, and Spark averages
what the shards come to. The driver holds the model, never the rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from possum.llm.spelling import BITS, _present
from possum.llm.staging import staged
from possum.llm.tasks import arrow_map

FOLDS = 5
SHARD_ROWS = 16_000  # labelled rows of one task in a round
WIDTH = 16  # numbers of a row of averages
TEMPERATURES = np.geomspace(0.25, 8, 61)
_NAMES = [f"v{k}" for k in range(WIDTH)]
_ONE, _MOST = float(1 << 32), float(1 << 18)


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = 0) -> Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train_labels(labels: DataFrame, label_col: str) -> DataFrame:
    """doc_id, y: all labelled ids outside the held-out fold.

    Rows with a null id or label are left out; of several labels of one id the
    smallest counts.
    """
    train = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).dropna()
    return train.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"))


def label_sample(labels: DataFrame, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` of ``train_labels``, in hash order: for trials. The operators train on all of them."""
    return train_labels(labels, label_col).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def shards(docs: DataFrame, task: Callable, features: str, labels: DataFrame, label_col: str) -> DataFrame:
    """doc_id, y, left and ``features`` for every row of ``train_labels`` that docs (doc_id, ...) have.

    ``task`` makes the features of labelled documents where they lie, and a
    bitmap of the labelled ids (of fixed size; the few others that it lets
    through find no label) keeps the rest from being made. Only the features are
    dealt out: by id, about ``SHARD_ROWS`` to a partition, in hash order, kept on
    the executors' disks (unpersist them). ``left`` marks a fifth that is for
    calibration. Of repeated ids the row with the smallest features counts.
    Each round starts a task per partition, so a session that deals a key out to
    more partitions than asked for gets no more shards for it.
    """
    slot = F.shiftright(F.xxhash64(F.col("doc_id").cast("string")), 1).bitwiseAND(F.lit(BITS - 1))
    train = staged(train_labels(labels, label_col), "labels")
    n = max(1, -(-train.join(docs.select("doc_id"), "doc_id", "left_semi").count() // SHARD_ROWS))
    present = docs.sparkSession.sparkContext.broadcast(_present(train.select(F.xxhash64(F.col("doc_id").cast("string")).alias("key"))))

    def labelled_only(batches):
        for b in batches:
            at = b.column(b.num_columns - 1).to_numpy()
            some = (present.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            if some.any():
                yield b.filter(pa.array(some))

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("__slot", slot)
    made = arrow_map(known, lambda batches: task(labelled_only(batches)), f"doc_id {kind}, {features}")
    made = made.select("doc_id", F.struct(*made.columns[1:]).alias("r"))
    both = made.select("doc_id", F.lit(None).cast("int").alias("y"), "r").unionByName(
        train.select("doc_id", "y", F.lit(None).cast(made.schema["r"].dataType).alias("r")))
    # an aggregate keeps the n partitions, a join would deal them anew
    rows = both.repartition(n, "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("r").alias("r"))
    rows = rows.filter(F.col("y").isNotNull() & F.col("r").isNotNull()).select(
        "doc_id", "y", (F.pmod(F.xxhash64(F.lit("left"), "doc_id"), F.lit(5)) == 0).alias("left"), "r.*")
    return rows.coalesce(n).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").persist(StorageLevel.DISK_ONLY)


def classes(rows: DataFrame) -> tuple[int, float]:
    """Number of classes of the rows (2: two or more) and the mean label (0 without rows)."""
    r = rows.agg(F.min("y").alias("a"), F.max("y").alias("b"), F.avg("y").alias("mean")).first()
    return (0, 0.0) if r.a is None else (1 + (r.a != r.b), float(r.mean))


def blocks(first: int, values: np.ndarray) -> pa.RecordBatch:
    """Numbers of a shard for ``averages``: rows of ``WIDTH`` numbers, counted from ``first``."""
    flat = np.ravel(values)
    table = np.zeros((-(-len(flat) // WIDTH), WIDTH))
    table.ravel()[:len(flat)] = flat
    return numbered(np.arange(first, first + len(table)), table)


def numbered(ids: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    fixed = np.rint(np.clip(table.astype(float), -_MOST, _MOST) * _ONE).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), *[pa.array(c) for c in fixed.T.copy()]], names=["row", *_NAMES])


def means(parts: DataFrame) -> DataFrame:
    """The mean of each row of ``numbered`` tables, in a task per core at most: a round's few rows don't fill the session's shuffle partitions."""
    mean = [(F.sum(n) / F.count(F.lit(1)) / F.lit(_ONE)).cast("float").alias(n) for n in _NAMES]
    return parts.groupBy("row").agg(*mean).coalesce(parts.sparkSession.sparkContext.defaultParallelism)


def averages(rows: DataFrame, task: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, in order, and the mean of each row over the shards whose ``task`` gave it.

    The numbers are added as integers, so the means do not depend on the order
    of the shards. The driver gets each row once, however many shards there are.
    """
    parts = arrow_map(rows, task, "row int, " + ", ".join(f"{n} long" for n in _NAMES))
    got = means(parts).toArrow().sort_by("row")
    return got["row"].to_numpy(), np.stack([got[n].to_numpy() for n in _NAMES], axis=1).reshape(-1, WIDTH)


def temperature_of(logits: DataFrame) -> float:
    """``temperature`` of a table of z and y; 1 if it is empty."""
    def loss(t: float) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(F.col("z") / F.lit(t), F.lit(50.0)), F.lit(-50.0))))
        p = F.greatest(F.least(p, F.lit(1 - 1e-7)), F.lit(1e-7))
        return F.sum(F.rint(-(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p)) * F.lit(_ONE)).cast("long"))

    sums = logits.agg(*[loss(float(t)).alias(f"t{k}") for k, t in enumerate(TEMPERATURES)]).first()
    return 1.0 if sums[0] is None else float(TEMPERATURES[int(np.argmin(sums))])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits that minimises log loss."""
    grid = TEMPERATURES
    p = np.clip(sigmoid(logits[None, :] / grid[:, None]), 1e-7, 1 - 1e-7)
    loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean(axis=1)
    return float(grid[int(loss.argmin())])


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)

    def state(self) -> np.ndarray:
        """The parameters, then the moments (the root of the second), as one array for ``blocks``."""
        return np.concatenate([np.ravel(a) for a in [*self.params, *self.m, *(np.sqrt(v) for v in self.v)]])

    def resume(self, state: np.ndarray, t: int) -> None:
        """Go on after ``t`` steps from a state."""
        self.t, at = t, 0
        for kept, power in ((self.params, 1), (self.m, 1), (self.v, 2)):
            for a in kept:
                a[...] = state[at:at + a.size].reshape(a.shape) ** power
                at += a.size
