"""Operator 12: reversible line dedup with cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.
Keys of at least ``MIN_POINTS`` code points that stand in at least ``MIN_DOCS``
documents are *repeated*: they lose all their lines but those of the largest
document id. An index of three tables holds what that needs:

``refs``     (k1, k2, doc_id): which document holds which key (128-bit digest)
``counts``   (k1, k2, n, largest): exact reference counts of the keys
``filters``  (shard, table): a cuckoo filter of each shard's repeated keys

``insert`` adds documents, ``delete`` takes documents back; both return a new
index over written tables, the old one stays as it was. A key whose count
reaches MIN_DOCS goes into its shard's filter, one that falls below leaves it
(cuckoo filters can forget, Bloom filters can't), so dropping documents restores
exactly the lines they took from others. ``dropped`` asks the filters first:
most lines stand in one document, and the filter turns them away without a
join; what passes is looked up in the exact counts, so a false positive never
costs a line.

Scale: references are told apart by (key, document), so a line that a third of
all documents hold is spread like any other, and counts are combined before
their shuffle. Keys with more than 1 / HEAVY of all references (so fewer than
HEAVY keys) are resolved by a broadcast of their counts; all others are probed
by shard, where a shard holds about ``SHARD_KEYS`` repeated keys and small
indexes send each shard to several tasks. Texts meet their dropped keys by
document id; nothing is collected.

Nulls and odd input: a null text has one empty line, like an empty one; rows
without id hold no keys and lose no lines; rows of one id are one document
whatever their number, also when it is inserted again; deleting unknown ids does
nothing; an empty table makes an empty index. Columns other than id and text
pass through ``clean`` untouched, whatever their names (but for the prefix
``__line_``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm.staging import staged
from possum.llm.tasks import arrow_map
from possum.llm.words import U, mix

MIN_POINTS = 20
MIN_DOCS = 3
HEAVY = 1 << 12         # heavier keys than 1 / HEAVY of all references are broadcast
SHARD_KEYS = 1 << 13    # repeated keys of a shard: a quarter of its filter's slots
WAYS = 4                # slots of a bucket
KICKS = 200
SPREAD = 4              # probe groups for each shuffle partition, at least
KEY = ("k1", "k2")


class LineIndex(NamedTuple):
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


# -- lines ---------------------------------------------------------------------

def line_key(line: bytes) -> bytes | None:
    """The digest of a line's key; None for keys that are too short to count."""
    key = line.strip().lower()      # of bytes: ASCII white space and letters only
    if len(key) < MIN_POINTS or (len(key) < 4 * MIN_POINTS and len(key.decode()) < MIN_POINTS):
        return None
    return md5(key, usedforsecurity=False).digest()


def _key_columns(keys: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    return [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())]


def references(docs: DataFrame) -> DataFrame:
    """k1, k2, doc_id: the distinct keys of every document with an id."""
    def task(batches):
        for b in batches:
            who, keys = [], []
            for k, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                mine = {line_key(line) for line in text.split(b"\n")}
                mine.discard(None)
                keys += mine
                who += [k] * len(mine)
                if len(who) > 1 << 16:
                    yield pa.RecordBatch.from_arrays([*_key_columns(keys), b.column(0).take(pa.array(who))], names=[*KEY, "doc_id"])
                    who, keys = [], []
            yield pa.RecordBatch.from_arrays([*_key_columns(keys), b.column(0).take(pa.array(who, pa.int64()))], names=[*KEY, "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    return arrow_map(rows, task, f"k1 long, k2 long, doc_id {kind}").distinct()


# -- cuckoo filters ------------------------------------------------------------

def _marks(k1: np.ndarray, k2: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and fingerprint (never 0) of each key."""
    mark = (k2.astype(np.uint64) & U(0xFFFF)).astype(np.uint16)
    return (k1.astype(np.uint64) & U(buckets - 1)).astype(np.int64), np.where(mark == 0, 1, mark).astype(np.uint16)


def _other(bucket: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
    return bucket ^ (mix(mark.astype(np.uint64)) & U(buckets - 1)).astype(np.int64)


def _rank(sorted_values: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of equal values."""
    return np.arange(len(sorted_values)) - np.searchsorted(sorted_values, sorted_values)


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints; every operation takes arrays of keys.

    A filter that can't place a key says "maybe" to everything from then on
    (``full``): its answers stay right, since exact counts follow, and the
    owner rebuilds it.
    """

    def __init__(self, buckets: int = SHARD_KEYS):
        self.table = np.zeros((buckets, WAYS), np.uint16)
        self.full = False

    @classmethod
    def load(cls, raw: bytes) -> Cuckoo:
        out = cls(1)
        out.full = raw[0] == 1
        out.table = np.frombuffer(raw, np.uint16, offset=2).reshape(-1, WAYS).copy()
        return out

    def dump(self) -> bytes:
        return bytes([int(self.full), 0]) + self.table.tobytes()

    def add(self, k1: np.ndarray, k2: np.ndarray) -> None:
        n = len(self.table)
        b, f = _marks(k1, k2, n)
        for kick in range(KICKS):
            order = np.argsort(b, kind="stable")
            b, f = b[order], f[order]
            taken = self.table[b] != 0
            free, rank = WAYS - taken.sum(axis=1), _rank(b)
            fits = rank < free
            slot = np.argsort(taken, axis=1, kind="stable")[fits, rank[fits]]
            self.table[b[fits], slot] = f[fits]
            b, f, rank = b[~fits], f[~fits], rank[~fits] - free[~fits]
            if not len(b):
                return
            # the first left over in a bucket takes a slot there; whoever has none tries its other bucket
            push = np.flatnonzero(rank == 0)
            way = ((mix(f[push].astype(np.uint64) + U(kick))) & U(WAYS - 1)).astype(np.int64)
            out = self.table[b[push], way].copy()
            self.table[b[push], way] = f[push]
            f[push] = out
            b = _other(b, f, n)
        self.full = True

    def remove(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Forget keys that are in the filter, one fingerprint for each."""
        n = len(self.table)
        b, f = _marks(k1, k2, n)
        first = np.minimum(b, _other(b, f, n))
        order = np.lexsort((f, first))
        first, f = first[order], f[order]
        nth = _rank(first * (1 << 16) + f)
        for r in range(int(nth.max(initial=-1)) + 1):   # equal fingerprints one after another
            x, g = first[nth == r], f[nth == r]
            for bucket in (x, _other(x, g, n)):
                here = self.table[bucket] == g[:, None]
                some = here.any(axis=1) & (g != 0)
                self.table[bucket[some], here[some].argmax(axis=1)] = 0
                g = np.where(some, np.uint16(0), g)

    def may_hold(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        if self.full:
            return np.ones(len(k1), bool)
        b, f = _marks(k1, k2, len(self.table))
        other = _other(b, f, len(self.table))
        return (self.table[b] == f[:, None]).any(axis=1) | (self.table[other] == f[:, None]).any(axis=1)


def _shard(shards: int) -> F.Column:
    return F.pmod(F.shiftrightunsigned("k2", 16), F.lit(shards)).cast("int")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(shard, kind, rows) for each stretch of a sorted partition."""
    for b in batches:
        shard, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
        cut = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(shard)], strict=True):
            if j > i:
                yield int(shard[i]), int(kind[i]), b.slice(i, j - i)


# kinds of the rows of one shard, in the order they are read
_TABLE, _ADD, _REMOVE, _PROBE = range(4)


def _update(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """The filters after ``changes`` (shard, kind, k1, k2), one shard after another."""
    def task(batches):
        now, shard = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([now.dump()], pa.binary())], names=["shard", "table"])

        for s, kind, rows in _groups(batches):
            if s != shard:
                if now is not None:
                    yield row()
                now, shard = Cuckoo(), s
            if kind == _TABLE:
                now = Cuckoo.load(rows.column("table")[0].as_py())
            else:
                (now.add if kind == _ADD else now.remove)(rows.column("k1").to_numpy(), rows.column("k2").to_numpy())
        if now is not None:
            yield row()

    none = F.lit(None).cast("long")
    tables = filters.select("shard", F.lit(_TABLE).alias("kind"), none.alias("k1"), none.alias("k2"), "table")
    rows = tables.unionByName(changes.select("shard", "kind", *KEY, F.lit(None).cast("binary").alias("table")))
    return arrow_map(rows.repartition("shard").sortWithinPartitions("shard", "kind"), task, "shard int, table binary")


def _empty_filters(like: DataFrame, shards: int) -> DataFrame:
    raw = F.unhex(F.repeat(F.lit("00"), 2 + 2 * WAYS * SHARD_KEYS))
    return like.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), raw.alias("table"))


def _built(refs: DataFrame, counts: DataFrame) -> LineIndex:
    """An index over written refs and counts with filters made anew."""
    repeated = counts.where(F.col("n") >= MIN_DOCS)
    shards = max(1, math.ceil(repeated.count() / SHARD_KEYS))
    changes = repeated.select(_shard(shards).alias("shard"), F.lit(_ADD).alias("kind"), *KEY)
    return LineIndex(refs, counts, staged(_update(_empty_filters(counts, shards), changes), "filters"), shards)


# -- the index -----------------------------------------------------------------

def build(docs: DataFrame) -> LineIndex:
    """The index of the documents."""
    refs = staged(references(docs), "refs")
    counts = refs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("largest"))
    return _built(refs, staged(counts, "counts"))


def _changed(index: LineIndex, refs: DataFrame, counts: DataFrame) -> LineIndex:
    """The index with new refs and counts (k1, k2, before, n, largest): keys that crossed MIN_DOCS move in or out of the filters."""
    now = staged(counts, "counts")
    new = now.where(F.col("n") > 0).select(*KEY, "n", "largest")
    up = (F.col("n") >= MIN_DOCS) & (F.col("before") < MIN_DOCS)
    down = (F.col("n") < MIN_DOCS) & (F.col("before") >= MIN_DOCS)
    changes = now.where(up | down).select(_shard(index.shards).alias("shard"), F.when(up, _ADD).otherwise(_REMOVE).alias("kind"), *KEY)
    filters = staged(_update(index.filters, changes), "filters")
    crowded = new.where(F.col("n") >= MIN_DOCS).count() > 2 * SHARD_KEYS * index.shards
    if crowded or filters.where(F.substring("table", 1, 1) == F.unhex(F.lit("01"))).limit(1).count():
        return _built(refs, new)
    return LineIndex(refs, new, filters, index.shards)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with further documents; keys that a document already holds count once."""
    more = staged(references(docs).join(index.refs, [*KEY, "doc_id"], "left_anti"), "new-refs")
    old = index.counts.select(*KEY, F.col("n").alias("before"), F.lit(0).cast("long").alias("more"), "largest")
    new = more.select(*KEY, F.lit(0).cast("long").alias("before"), F.lit(1).cast("long").alias("more"), F.col("doc_id").alias("largest"))
    counts = old.unionByName(new).groupBy(*KEY).agg(
        F.sum("before").alias("before"), (F.sum("before") + F.sum("more")).alias("n"), F.max("largest").alias("largest"))
    return _changed(index, staged(index.refs.unionByName(more), "refs"), counts)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents of ``ids`` (doc_id); unknown ids do nothing."""
    ids = ids.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    gone = staged(index.refs.join(ids, "doc_id", "left_semi").select(*KEY, "doc_id"), "gone-refs")
    refs = staged(index.refs.join(ids, "doc_id", "left_anti").select(*KEY, "doc_id"), "refs")
    less = gone.groupBy(*KEY).agg(F.count(F.lit(1)).alias("less"), F.max("doc_id").alias("top"))
    touched = staged(index.counts.join(less, [*KEY], "left"), "touched")
    # only keys that lost their largest document ask the references for the next one
    orphans = touched.where((F.col("top") == F.col("largest")) & (F.col("n") > F.col("less"))).select(*KEY)
    heirs = refs.join(orphans, [*KEY], "left_semi").groupBy(*KEY).agg(F.max("doc_id").alias("heir"))
    counts = touched.join(heirs, [*KEY], "left").select(
        *KEY, F.col("n").alias("before"), (F.col("n") - F.coalesce("less", F.lit(0))).alias("n"), F.coalesce("heir", "largest").alias("largest"))
    return _changed(index, refs, counts)


def probe(index: LineIndex, refs: DataFrame) -> DataFrame:
    """The references whose keys the filters may hold."""
    spread = max(1, math.ceil(SPREAD * int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions")) / index.shards))

    def task(batches):
        now, shard = None, None
        for s, kind, rows in _groups(batches):
            if kind == _TABLE:
                now, shard = Cuckoo.load(rows.column("table")[0].as_py()), s
            else:   # a group without a filter, which no index makes, would pass whole
                some = now.may_hold(rows.column("k1").to_numpy(), rows.column("k2").to_numpy()) if s == shard else np.ones(len(rows), bool)
                yield pa.RecordBatch.from_arrays([rows.column(c).filter(pa.array(some)) for c in (*KEY, "doc_id")], names=[*KEY, "doc_id"])

    # a group is a shard and a part of its references; each group reads the shard's filter first
    kind = refs.schema["doc_id"].dataType.simpleString()
    part = F.pmod(F.xxhash64("k1", "doc_id"), F.lit(spread)).cast("int")
    none = F.lit(None).cast("long")
    copies = index.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    tables = copies.select((F.col("shard") * spread + F.col("part")).alias("shard"), F.lit(_TABLE).alias("kind"),
                           none.alias("k1"), none.alias("k2"), F.lit(None).cast(kind).alias("doc_id"), "table")
    rows = refs.select((_shard(index.shards) * spread + part).alias("shard"), F.lit(_PROBE).alias("kind"), *KEY, "doc_id",
                       F.lit(None).cast("binary").alias("table"))
    both = tables.unionByName(rows).repartition("shard").sortWithinPartitions("shard", "kind")
    return arrow_map(both, task, f"k1 long, k2 long, doc_id {kind}")


def dropped(index: LineIndex) -> DataFrame:
    """doc_id, k1, k2: the keys that each document of the index loses."""
    repeated = index.counts.where(F.col("n") >= MIN_DOCS).select(*KEY, "n", "largest")
    total = index.counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    many = F.col("n") * HEAVY > total
    heavy = F.broadcast(repeated.where(many).select(*KEY, "largest"))      # fewer than HEAVY rows
    first = index.refs.join(heavy, [*KEY], "left_anti")
    passed = probe(index, first).join(repeated.where(~many), [*KEY]).select("doc_id", *KEY, "largest")
    common = index.refs.join(heavy, [*KEY]).select("doc_id", *KEY, "largest")
    return passed.unionByName(common).where(F.col("doc_id") < F.col("largest")).select("doc_id", *KEY)


# -- texts ---------------------------------------------------------------------

def clean(index: LineIndex, docs: DataFrame) -> DataFrame:
    """The documents without the lines they lose, with ``__line_total`` and ``__line_dropped``.

    The index must hold the documents. A null text stays null.
    """
    columns = docs.columns
    at = columns.index("text")
    lost = dropped(index).groupBy(F.col("doc_id").alias("__line_id")).agg(F.collect_list(F.struct(*KEY)).alias("__line_keys"))
    named = docs.where(F.col("doc_id").isNotNull())
    kind = lost.schema["__line_keys"].dataType
    rows = named.join(lost, named["doc_id"] == lost["__line_id"], "left").select(*[named[c] for c in columns], "__line_keys")
    # rows without id would all meet in one task of the join
    rows = rows.unionByName(docs.where(F.col("doc_id").isNull()).withColumn("__line_keys", F.lit(None).cast(kind)))

    def task(batches):
        for b in batches:
            lists = b.column(len(columns))
            texts, total, gone = [], [], []
            for k, text in enumerate(b.column(at).cast(pa.binary()).to_pylist()):
                lines = (text or b"").split(b"\n")
                left = lines
                if lists[k].is_valid:
                    pairs = lists[k].values
                    drop = set(np.stack([pairs.field(0).to_numpy(), pairs.field(1).to_numpy()], 1).astype("<i8").view("V16").ravel().tolist())
                    left = [line for line in lines if line_key(line) not in drop]
                texts.append(None if text is None else b"\n".join(left))
                total.append(len(lines))
                gone.append(len(lines) - len(left))
            out = [b.column(k) for k in range(len(columns))]
            out[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*columns, "__line_total", "__line_dropped"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__line_total", T.LongType()), T.StructField("__line_dropped", T.LongType())])
    return arrow_map(rows, task, schema)


def deduplicate_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines: an index of them all, then ``clean``."""
    return clean(build(docs), docs)
