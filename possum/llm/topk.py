"""Operator 1: exact top-k by inner product, with norm buckets.

Vectors become integers, ``floor(256 * x)``. All vectors are dealt by length,
longest first, and every task cuts what it reads into buckets of vectors of
like length. A query brings a lower bound of its k-th best score, first from
the longest vectors of the table, then from what the task has seen. Against a
bucket whose longest vector has length l, a query of length |q| needs a cosine
of at least ``t = bound / (|q| l)``:

* t > 1: no vector of the bucket can do, it is passed over;
* most queries' t at least ``COORDINATE_FROM``: coordinate pruning. A vector
  reaches cosine t only if each of its largest query coordinates lies in an
  interval around the query's; rows outside are left out;
* else length pruning: rows shorter than ``bound / |q|`` are left out.

What remains is verified with exact integer products. Each task returns its k
best per query, and the k best of those are kept.

Queries are served in blocks of ``QUERY_BLOCK``; a block is sent to every task.

Nulls and odd input: rows without id, and vectors null or with a null or
non-finite component, take no part; only vectors of one dimension are compared;
a vector of length 0 scores 0; a repeated query id is searched once, with its
smallest vector, against the rows of all other ids; repeated candidate rows
each count; with fewer than k candidates all are returned; an empty table gives
no rows. Ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from possum.llm.staging import staged
from possum.llm.tasks import arrow_map

SCALE = 256
BUCKET = 1024
QUERY_BLOCK = 4096
SEEDS = 1024  # longest vectors that give the first bounds
COORDINATE_FROM = 0.8
FOCUS = 3     # coordinates looked at


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v array<long>, dim, norm of the rows that take part."""
    x = F.col("e")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    out = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("e"))
    out = out.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(~bad)
    out = out.select("vec_id", F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return out.select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


def _arrays(t: pa.Table | pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """dim -> ids, matrix, norms."""
    ids, dims, norms = (t.column(c).to_numpy(zero_copy_only=False) if isinstance(t, pa.RecordBatch)
                        else t.column(c).to_numpy() for c in (0, 2, 3))
    col = t.column(1)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(dims.astype(np.int64))
    out = {}
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        at = (ends[rows] - d)[:, None] + np.arange(d)
        out[int(d)] = ids[rows], flat[at].reshape(len(rows), d), norms[rows]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; by float64 where every sum stays below 2**53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


class Search:
    """The k best of some queries over the buckets shown to it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, k: int):
        self.ids, self.q, self.norms, self.k = ids, vectors, norms, k
        n = len(ids)
        self.bound = np.full(n, -np.inf)
        self.owner, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        unit = vectors / np.where(norms > 0, norms, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.at_focus = np.take_along_axis(unit, self.focus, axis=1)

    def bucket(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> None:
        """A bucket sorted by length, longest first."""
        top = norms[0]
        reach = self.norms * top
        live = np.flatnonzero(self.bound <= reach * (1 + 1e-9))
        if not len(live):
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(reach[live] > 0, self.bound[live] / reach[live], -1.0)
        if np.median(t) >= COORDINATE_FROM:
            owner, row = self._by_coordinate(live, np.clip(t, -1, 1), vectors, norms)
            score = np.concatenate([np.zeros(0, np.int64), *(
                products(self.q[o:o + 1], vectors[row[owner == o]])[0] for o in np.unique(owner))])
        else:
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(self.norms[live] > 0, self.bound[live] / self.norms[live], -np.inf)
            n = np.searchsorted(-norms, -least * (1 - 1e-9), "right")
            s = products(self.q[live], vectors[:n.max(initial=0)])
            ok = (s >= self.bound[live, None]) & (np.arange(s.shape[1]) < n[:, None])
            at, row = np.nonzero(ok)
            owner, score = live[at], s[at, row]
        keep = (score >= self.bound[owner]) & (ids[row] != self.ids[owner])
        self._add(owner[keep], ids[row[keep]], score[keep])

    def _by_coordinate(self, live, t, vectors, norms):
        """Pairs (query, row) that pass the intervals of the query's focus coordinates; by query."""
        unit = vectors / np.where(norms > 0, norms, 1)[:, None]
        owners, rows = [], []
        for o, need in zip(live, t, strict=True):
            ok = np.ones(len(vectors), bool)
            if need > 0:
                for f, x in zip(self.focus[o], self.at_focus[o], strict=True):
                    wide = np.sqrt(max(0.0, (1 - need * need) * (1 - x * x)))
                    # cosine >= need with a unit coordinate c: |c - need x| <= wide, or any c beyond where x itself allows
                    low = need * x - wide if x > -need else -1.0
                    high = need * x + wide if x < need else 1.0
                    ok &= (unit[:, f] >= low - 1e-9) & (unit[:, f] <= high + 1e-9)
            r = np.flatnonzero(ok)
            owners.append(np.full(len(r), o))
            rows.append(r)
        return np.concatenate(owners), np.concatenate(rows)

    def _add(self, owner: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        if not len(owner):
            return
        owner, found, score = (np.concatenate(p) for p in (
            (self.owner, owner), (self.found, found), (self.score, score)))
        order = np.lexsort((found, -score, owner))
        owner, found, score = owner[order], found[order], score[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
        keep = rank < self.k
        self.owner, self.found, self.score = owner[keep], found[keep], score[keep]
        last = rank == self.k - 1
        self.bound[owner[last]] = np.maximum(self.bound[owner[last]], score[last])

    def table(self, rows: dict[int, tuple]) -> None:
        for ids, vectors, norms in rows.values():
            if vectors.shape[1] != self.q.shape[1]:
                continue
            order = np.lexsort((ids, -norms))
            for at in range(0, len(order), BUCKET):
                part = order[at:at + BUCKET]
                self.bucket(ids[part], vectors[part], norms[part])


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on vec_id."""
    spark = table.sparkSession
    vectors = integer_vectors(table, id_col, vector_col)
    vectors = staged(vectors.repartitionByRange(F.col("norm").desc(), F.col("vec_id"))
                     .sortWithinPartitions(F.col("norm").desc(), F.col("vec_id")), "vectors")
    queries = vectors.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "dim", "norm")).alias("r"))
    queries = staged(queries.select("vec_id", "r.*"), "queries")
    seeds = vectors.orderBy(F.col("norm").desc(), "vec_id").limit(SEEDS).toArrow()
    n_blocks = -(-queries.count() // query_block)

    def run(block):
        def task(batches):
            searches = {}
            for d, (q, first) in block.value.items():
                searches[d] = Search(*q, k)
                searches[d].bound = first.copy()
            for b in batches:
                rows = _arrays(b)
                for s in searches.values():
                    s.table(rows)
            for s in searches.values():
                yield pa.RecordBatch.from_arrays([pa.array(s.ids[s.owner]), pa.array(s.found), pa.array(s.score)],
                                                 names=["query_id", "vec_id", "score"])
        return task

    out = None
    for b in range(n_blocks):
        part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).toArrow()
        block = {}
        for d, q in _arrays(part).items():
            s = Search(*q, k)
            s.table(_arrays(seeds))
            block[d] = q, s.bound
        found = arrow_map(vectors, run(spark.sparkContext.broadcast(block)), "query_id long, vec_id long, score long")
        out = found if out is None else out.unionAll(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
