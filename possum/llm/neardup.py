"""Operator 8: near-duplicate documents by an inverted join of MinHash coordinates.

1. Every text becomes the set of its distinct 5-word shingles and a MinHash
   signature of ``K`` coordinates. Texts with equal sets (compared by size and
   two 64-bit sums) are one class; only classes are compared.
2. A class is posted under (coordinate, value) pairs. Two sets of similarity
   0.75 agree in 48 of 64 coordinates on average, and in fewer than
   ``MATCHES`` with a chance of about 1e-7; so a class is posted under its
   ``K - MATCHES + 1`` rarest pairs only (prefix), and two classes that agree in
   ``MATCHES`` coordinates still meet under one of them. Frequent pairs, such as
   those of a common passage, are skipped this way.
3. In each posting list the members are linked to the list's middle member: the
   one with the most common pairs (the core of a large group, and so the same in
   all its lists), or else the one nearest to the majority of the members'
   one-bit sketches. Linked pairs
   are verified on the signatures (at least ``MATCHES`` collisions) and then on
   the full sets, and connected classes get one label.
4. What is left are pairs of members of one list with different labels. They are
   passed over if their sizes or sketches rule a link out, or if what both share
   with the list's middle member, known exactly, plus what they can share
   outside it does. The members with an open pair meet again with their
   signatures, where collisions are counted; those of a pair with at least
   ``MATCHES`` meet with their full sets. What leaves a task is its members, and
   in the end a spanning forest of the links found.

No step puts out the pairs of a group: every output has at most one row per
member of a list. Members that already have one label are not compared, and two
classes are compared in one list only. Lists of frequent pairs are cut into
blocks of ``BLOCK`` members, open members into chunks of ``CHUNK_ITEMS``
shingles, and blocks and chunks meet two by two, so no task holds more than two
of them, however large a group is. The comparisons inside a group of near
copies that are not linked still grow with the square of the group.

Nulls and odd input: a text without words has an empty set and is linked with
nothing; a text of fewer than five words is one shingle; rows without id are
not linked, have no component and are kept; repeated rows are one class, and
rows of one id but different texts are compared like any others. An empty table
gives no rows. Columns other than id and text pass through ``deduplicate``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.llm.staging import staged
from possum.llm.tasks import arrow_map
from possum.llm.words import U, chunks, mix, split

SHINGLE = 5
PERCENT = 75
K = 64
MATCHES = 30
PREFIX = K - MATCHES + 1
AGREE = 42        # of 64 sketch bits; two sets of similarity 0.75 agree in 56 on average
FREQUENT = 2000   # a pair is frequent if at least 1 / FREQUENT of the classes have it
BLOCK = 2048
SIGNED = 1024     # signatures that are posted together
POSTED = 1 << 16  # list members that leave a task as one batch, and the copies of one more
CHUNK_ITEMS = 1 << 19  # shingles of a list's open members that are compared as one chunk
SLOTS = 1 << 24   # bits of the filter of documents whose sets are needed
HEAVY = 4096      # a class is heavy if more than 1 / HEAVY of the rows are its copies
MARKS = 512       # bits of the sketches of what a set lacks of the middle member, and has beside it
_STEP = U(0x9E3779B97F4A7C15)

_rng = np.random.default_rng(8)
_A = _rng.integers(0, 1 << 63, K, dtype=np.uint64) * U(2) + U(1)
_B = _rng.integers(0, 1 << 63, K, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text of a chunk."""
    w = split(data, offs)
    h, out = w.hashes, []
    n = max(0, len(h) - SHINGLE + 1)
    s = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        s = s * _STEP + h[k:k + n]
    s = mix(s)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(s[a:b - SHINGLE + 1]))
        elif b > a:
            one = U(b - a)
            for x in h[a:b]:
                one = mix(np.array([one]) * _STEP + x)[0]
            out.append(np.array([one], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """K minima per set, uint32; sets must not be empty."""
    out = np.empty((len(sets), K), np.uint32)
    if sets:
        u = np.concatenate(sets)
        first = np.cumsum([0] + [len(s) for s in sets[:-1]])
        for k in range(K):
            out[:, k] = np.minimum.reduceat(((u * _A[k] + _B[k]) >> U(32)).astype(np.uint32), first)
    return out


def class_key(s: np.ndarray) -> tuple[int, int]:
    return int(s.sum(dtype=np.uint64)), int(mix(s ^ _STEP).sum(dtype=np.uint64))


def sketch(sig: np.ndarray) -> np.ndarray:
    """One bit of each coordinate as a uint64 per signature."""
    return np.packbits((sig & 1).astype(np.uint8), axis=1).view(">u8").ravel().astype(np.uint64)


def _binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def _sign(docs: DataFrame) -> DataFrame:
    """doc_id, tag, n, f1, f2, sig of every row; tag is a hash of the text, sig is null for an empty set."""
    def task(batches):
        for b in batches:
            n, f1, f2, sig = [], [], [], []
            for _, _, data, offs in chunks(b.column(1)):
                sets = shingle_sets(data, offs)
                some = iter(signatures([s for s in sets if len(s)]))
                for s in sets:
                    x, y = class_key(s)
                    n.append(len(s))
                    f1.append(x)
                    f2.append(y)
                    sig.append(next(some).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(np.array(f1, np.uint64).view(np.int64)),
                 pa.array(np.array(f2, np.uint64).view(np.int64)), _binary(sig)], names=["doc_id", "tag", "n", "f1", "f2", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    return arrow_map(docs, task, f"doc_id {kind}, tag long, n long, f1 long, f2 long, sig binary")


def _signature_rows(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), K)


def _pairs_of(sig: np.ndarray) -> np.ndarray:
    """(coordinate, value) as one integer below 2**38."""
    return (np.arange(K, dtype=np.int64) << 32) + sig.astype(np.int64)


def _frequent_pairs(classes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pairs and about how many classes have them, at most K * FREQUENT.

    Only pairs that a batch has twice are counted, so rare ones cost nothing.
    The counts set the order of pairs and the blocks of lists, not the result.
    """
    def task(batches):
        for b in batches:
            p, n = np.unique(_pairs_of(_signature_rows(b.column(0))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(p[n > 1]), pa.array(n[n > 1])], names=["pair", "n"])

    counts = arrow_map(classes.select("sig"), task, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    least = max(2, classes.count() // FREQUENT)
    got = counts.filter(F.col("n") >= least).toArrow().sort_by("pair")
    return got["pair"].to_numpy(), got["n"].to_numpy()


def _prefix(sig: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per signature: its ``PREFIX`` rarest pairs, about how many classes have each, and the sum over all its pairs."""
    p = _pairs_of(sig)
    if len(pairs):
        at = np.minimum(np.searchsorted(pairs, p), len(pairs) - 1)
        known = np.where(pairs[at] == p, counts[at], 0)
    else:
        known = np.zeros(p.shape, np.int64)
    order = np.minimum(known, (1 << 24) - 1) << 38 | p
    pick = np.argpartition(order, PREFIX - 1, axis=1)[:, :PREFIX]
    return np.take_along_axis(p, pick, axis=1), np.take_along_axis(known, pick, axis=1), known.sum(axis=1)


def _posting_lists(classes: DataFrame, frequent) -> DataFrame:
    """pair, block, middle, and arrays cls, n, sketch, side: the lists of two or more classes."""
    def post(batches):
        for b in batches:
            for at in range(0, b.num_rows, SIGNED):
                part = b.slice(at, SIGNED)
                cls, n = (part.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
                sig = _signature_rows(part.column(2))
                p, known, common = _prefix(sig, *frequent.value)
                p, known, bits = p.ravel(), known.ravel(), sketch(sig).view(np.int64)
                row = np.repeat(np.arange(len(cls)), PREFIX)
                blocks = np.maximum(1, -(-known // BLOCK))
                own = (mix(cls.view(np.uint64))[row] % blocks.astype(np.uint64)).astype(np.int64)
                # a member of block i meets every block j under (min, max)
                before = np.cumsum(blocks) - blocks
                cuts = np.unique(np.searchsorted(before, np.arange(0, before[-1] + 1, POSTED)))
                for i, j in zip(cuts, np.append(cuts[1:], len(row)), strict=True):
                    copy = np.repeat(np.arange(i, j), blocks[i:j])
                    other = np.arange(len(copy)) + before[i] - before[copy]
                    lo, hi = np.minimum(own[copy], other), np.maximum(own[copy], other)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p[copy]), pa.array(lo * blocks[copy] + hi), pa.array(cls[row[copy]]), pa.array(n[row[copy]]),
                         pa.array(bits[row[copy]]),
                         pa.array(np.where(lo == hi, 2, own[copy] == hi).astype(np.int8)), pa.array(common[row[copy]])],
                        names=["pair", "block", "cls", "n", "sketch", "side", "common"])

    posted = arrow_map(classes.select("cls", "n", "sig"), post,
                       "pair long, block long, cls long, n long, sketch long, side tinyint, common long")
    posted = posted.repartition("pair", "block").sortWithinPartitions("pair", "block", "cls")

    def gather(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            cols = [c.to_numpy() for c in t.columns]
            new = np.flatnonzero(np.append(True, (np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)))
            rest = t.slice(int(new[-1]))
            yield from _lists(cols, new[:-1], new[1:])
        if rest is not None and rest.num_rows:
            yield from _lists([c.to_numpy() for c in rest.columns], np.array([0]), np.array([rest.num_rows]))

    return staged(arrow_map(posted, gather, "pair long, block long, middle long, cls array<long>, n array<long>, "
                                            "sketch array<long>, side array<tinyint>"), "lists")


def _lists(cols, starts, ends):
    pair, block, cls, n, sk, side, common = cols
    many = np.flatnonzero(ends - starts > 1)
    out = [[] for _ in range(7)]
    for a, b in zip(starts[many], ends[many], strict=True):
        s = sk[a:b].view(np.uint64)
        bits = np.unpackbits(s.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        middle = (bits.sum(axis=0, dtype=np.int64) * 2 > b - a).astype(np.uint64)
        middle = (middle << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)
        far = np.bitwise_count(s ^ middle).astype(np.int64)
        m = int(np.lexsort((far, -common[a:b]))[0])  # ties to the smallest cls: rows are in its order
        for o, x in zip(out, (pair[a], block[a], cls[a + m], cls[a:b], n[a:b], sk[a:b], side[a:b]), strict=True):
            o.append(x)
    if out[0]:
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 3 + [pa.list_(pa.int8())]
        yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)],
                                         names=["pair", "block", "middle", "cls", "n", "sketch", "side"])


def _fits(n1, n2, s1, s2):
    """Whether sizes and sketches allow a link."""
    return (100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2)) & (np.bitwise_count(s1 ^ s2) <= 64 - AGREE)


def _star(lists: DataFrame) -> DataFrame:
    """u, v: the middle member of each list with every member that may be linked to it."""
    def task(batches):
        for b in batches:
            us, vs = [], []
            for r in range(b.num_rows):
                middle = b.column(2)[r].as_py()
                cls, n, sk = (b.column(c)[r].values.to_numpy() for c in (3, 4, 5))
                m = int(np.flatnonzero(cls == middle)[0])
                ok = _fits(n, n[m], sk.view(np.uint64), sk.view(np.uint64)[m])
                ok[m] = False
                us.append(np.full(int(ok.sum()), middle))
                vs.append(cls[ok])
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                p = np.unique(np.stack([u, v], 1), axis=0) if len(u) else np.zeros((0, 2), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["u", "v"])

    return staged(arrow_map(lists, task, "u long, v long").distinct(), "star")


def _needed_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """cls, sig, items of the classes in ids (cls), made again from each one's smallest document."""
    need = staged(classes.select("cls", "rep").join(ids.distinct(), "cls").select("cls", F.xxhash64("rep").alias("id_key")), "need")
    slot = F.pmod(F.col("id_key"), F.lit(SLOTS)) + 1  # bitmaps count from 1
    bits = need.select(F.bitmap_bucket_number(slot).alias("b"), F.bitmap_bit_position(slot).alias("p")) \
        .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect()  # SLOTS bits at most
    whole = np.zeros(SLOTS // 8, np.uint8)
    for b, raw in bits:
        at = (b - 1) * 4096
        whole[at:at + 4096] = np.frombuffer(bytes(raw), np.uint8)[:len(whole) - at]
    shared = docs.sparkSession.sparkContext.broadcast(whole)

    def task(batches):
        have = set()
        for b in batches:
            slots = np.mod(b.column(1).to_numpy(zero_copy_only=False), SLOTS)
            rows = np.flatnonzero((shared.value[slots >> 3] >> (slots & 7)) & 1)
            texts = b.column(2).take(pa.array(rows))
            for _, _, data, offs in chunks(texts):
                sets = [s for s in shingle_sets(data, offs) if len(s)]
                keys = [class_key(s) for s in sets]
                new = []
                for k, key in enumerate(keys):
                    if key not in have:
                        have.add(key)
                        new.append(k)
                sig = signatures([sets[k] for k in new])
                f = np.array([keys[k] for k in new], np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array([len(sets[k]) for k in new], pa.int64()),
                     _binary([s.tobytes() for s in sig]), _binary([sets[k].tobytes() for k in new])],
                    names=["f1", "f2", "n", "sig", "items"])

    found = arrow_map(docs.select("doc_id", F.xxhash64("doc_id").alias("id_key"), "text"), task, "f1 long, f2 long, n long, sig binary, items binary")
    found = found.withColumn("cls", F.xxhash64("f1", "f2", "n")).drop("f1", "f2")
    found = found.join(need.select("cls").distinct(), "cls", "left_semi")
    return staged(found.groupBy("cls").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("items").alias("items")), "sets")


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of a are in b; both sorted, b not empty."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return b[at] == a


def _marks(items: np.ndarray) -> bytes:
    """A bit for each item, by its hash; items that share a bit make the bits fewer than the items."""
    mark = np.zeros(MARKS, np.uint8)
    mark[(items % U(MARKS)).astype(np.int64)] = 1
    return np.packbits(mark).tobytes()


def _most_shared(n, size, i, js, shared, outside, missing):
    """An upper bound of what member i shares with members js, from what each shares with a set of ``size``.

    Inside the set two members share what neither lacks, and every marked bit
    stands for something lacking; outside it a member's bits that the other
    does not have stand for something it has alone.
    """
    def bits(x):
        return np.bitwise_count(x).sum(axis=1).astype(np.int64)

    inside = np.minimum(size - bits(missing[i] | missing[js]), np.minimum(shared[i], shared[js]))
    alone_i, alone_j = bits(outside[i] & ~outside[js]), bits(outside[js] & ~outside[i])
    return inside + np.minimum(n[i] - shared[i] - alone_i, n[js] - shared[js] - alone_j)


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, shared, outside, missing, link: the exact count, and sketches of v without u and of u without v."""
    a = sets.select(F.col("cls").alias("u"), F.col("sig").alias("sig_u"), F.col("items").alias("items_u"))
    b = sets.select(F.col("cls").alias("v"), F.col("sig").alias("sig_v"), F.col("items").alias("items_v"))
    both = pairs.join(b, "v").join(a, "u").select("u", "v", "sig_u", "items_u", "sig_v", "items_v")

    def task(batches):
        for batch in batches:
            shared, outside, missing, link = [], [], [], []
            for r in range(batch.num_rows):
                su, iu, sv, iv = (batch.column(c)[r].as_buffer() for c in (2, 3, 4, 5))
                x, y = np.frombuffer(iu, np.uint64), np.frombuffer(iv, np.uint64)
                inside = _within(y, x)
                n = int(inside.sum())
                hits = int((np.frombuffer(su, np.uint32) == np.frombuffer(sv, np.uint32)).sum())
                shared.append(n)
                outside.append(_marks(y[~inside]))
                missing.append(_marks(x[~_within(x, y)]))
                link.append(hits >= MATCHES and 100 * n >= PERCENT * (len(x) + len(y) - n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), _binary(outside), _binary(missing),
                 pa.array(link, pa.bool_())], names=["u", "v", "shared", "outside", "missing", "link"])

    return staged(arrow_map(both, task, "u long, v long, shared long, outside binary, missing binary, link boolean"), "verified")


def connected(edges: DataFrame) -> DataFrame:
    """id, label of every id in edges (u, v): the smallest id reachable.

    Every round takes the smallest label of the neighbours, then the label's
    own label; the rounds needed grow with the logarithm of the longest path
    for most graphs, and each is a written table.
    """
    both = staged(edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.min("u")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "v"), "v").groupBy(F.col("u").alias("id"))
                .agg(F.min("label").alias("near")))
        new = labels.join(near, "id", "left").select("id", "label", F.least("label", "near").alias("next"))
        up = labels.select(F.col("id").alias("next"), F.col("label").alias("up"))
        new = staged(new.join(up, "next", "left").select("id", F.col("label").alias("old"),
                                                         F.least("next", F.coalesce("up", "next")).alias("label")), "labels")
        labels = new.select("id", "label")
        if new.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


def _open_members(lists: DataFrame, labels: DataFrame, star: DataFrame) -> DataFrame:
    """pair, block, lo, hi, part, cls, label: members of a list that may still be linked to one of another label.

    What a list leaves open is cut into chunks of ``CHUNK_ITEMS`` shingles;
    chunks meet two by two in a cell (lo, hi), so no cell holds more than two
    chunks. Two bits of ``part`` name a member's chunk and block in the cell,
    the two above them say which of these must differ for two members to meet.
    """
    lists = lists.withColumn("list", F.struct("pair", "block"))
    m = lists.select("list", "middle", F.explode(F.arrays_zip("cls", "n", "sketch", "side")).alias("m")).select("list", "middle", "m.*")
    m = m.join(labels.select(F.col("id").alias("cls"), "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    known = star.select(F.col("u").alias("middle"), F.col("v").alias("cls"), "shared", "outside", "missing")
    m = m.join(known, ["middle", "cls"], "left")
    one = F.struct("cls", "n", "sketch", "side", "label", "shared", "outside", "missing")
    groups = (m.groupBy("list").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.first("middle").alias("middle"),
                                    F.sort_array(F.collect_list(one)).alias("m"))
              .filter(F.col("a") != F.col("b")))  # a list is two blocks at most
    groups = groups.select("list.pair", "list.block", "middle", *[F.col(f"m.{c}").alias(c) for c in
                                                                  ("cls", "n", "sketch", "side", "label", "shared", "outside", "missing")])

    def task(batches):
        for b in batches:
            rows = [np.zeros((0, 7), np.int64)]
            for r in range(b.num_rows):
                pair, block, middle = (b.column(c)[r].as_py() for c in range(3))
                cls, n, sk, side, label = (b.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(3, 8))
                shared = np.array([-1 if x is None else x for x in b.column(8)[r].as_py()], np.int64)
                outside, missing = (np.stack([np.frombuffer(x or bytes(MARKS // 8), np.uint64) for x in b.column(c)[r].as_py()])
                                    for c in (9, 10))
                is_open = _still_open(middle, cls, n, sk.view(np.uint64), side, label, shared, outside, missing)
                if len(is_open):
                    rows.append(_cells(pair, block, cls[is_open], n[is_open], side[is_open], label[is_open]))
            out = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, k]) for k in range(7)], names=list(_CELL))

    return staged(arrow_map(groups, task, ", ".join(f"{c} long" for c in _CELL)), "open")


_CELL = ("pair", "block", "lo", "hi", "part", "cls", "label")


def _still_open(middle, cls, n, sk, side, label, shared, outside, missing) -> np.ndarray:
    """The members of one list with a partner of another label that nothing known so far rules out."""
    size = int(n[cls == middle][0])
    ids, members = np.unique(label, return_counts=True)
    main = ids[members.argmax()]  # members of the largest label are not compared with each other
    rest = np.flatnonzero((label != main) & (cls != middle))
    found = np.zeros(len(cls), bool)
    for k, i in enumerate(rest):
        later = np.ones(len(cls), bool)
        later[rest[:k + 1]] = False
        ok = later & (label != label[i]) & (cls != middle) & _fits(n, n[i], sk, sk[i])
        ok &= (side == 2) | (side != side[i])
        if shared[i] >= 0:
            js = np.flatnonzero(ok & (shared >= 0))
            most = _most_shared(n, size, i, js, shared, outside, missing)
            ok[js[100 * most < PERCENT * (n[i] + n[js] - most)]] = False
        found |= ok
        found[i] |= ok.any()
    return np.flatnonzero(found)


def _cells(pair, block, cls, n, side, label) -> np.ndarray:
    """One row of ``_CELL`` per member and chunk it meets."""
    chunk = (np.cumsum(n) - n) // CHUNK_ITEMS
    chunk = np.unique(chunk, return_inverse=True)[1]
    copies = int(chunk.max()) + 1
    row = np.repeat(np.arange(len(cls)), copies)
    own, other = chunk[row], np.tile(np.arange(copies), len(cls))
    lo, hi = np.minimum(own, other), np.maximum(own, other)
    code = 2 * (own == hi) + (side[row] == 1)
    need = 2 * (lo != hi) + (side[row] != 2)  # side 2: a list of one block, where all meet
    return np.stack([np.full(len(row), pair), np.full(len(row), block), lo, hi, 4 * need + code, cls[row], label[row]], 1)


def _meet(one: int, others: np.ndarray) -> np.ndarray:
    """Whether members of one cell are of different chunks and blocks, where it has two."""
    return ((one ^ others) & (one >> 2)) == one >> 2


def _by_cell(cells: DataFrame, more: list[str], work, schema: str, name: str) -> DataFrame:
    """What ``work(key, columns)`` makes of every cell; columns are those of ``_CELL`` after the key, then ``more``."""
    key = list(_CELL[:4])
    cells = cells.select(*_CELL, *more).repartition(*key).sortWithinPartitions(*key, "cls")

    def task(batches):
        at, members = None, []
        for b in batches:
            for r, k in enumerate(zip(*(b.column(c).to_pylist() for c in range(4)), strict=True)):
                if k != at:
                    if len(members) > 1:
                        yield work(at, list(zip(*members, strict=True)))
                    at, members = k, []
                members.append([b.column(c)[r].as_py() for c in range(4, b.num_columns)])
        if len(members) > 1:
            yield work(at, list(zip(*members, strict=True)))

    return staged(arrow_map(cells, task, schema), name)


def _candidates(at, part, label, sig, n, posted):
    """(i, members after it that it has to be compared with), by signatures; label may change between rounds.

    A pair is looked at in the first list that both its classes are posted under.
    """
    posted = np.where(posted < at[0], posted, -1)  # an earlier list of both has the pair
    for i in range(len(part) - 1):
        js = np.arange(i + 1, len(part))
        js = js[_meet(part[i], part[js]) & (label[js] != label[i])
                & (100 * np.minimum(n[js], n[i]) >= PERCENT * np.maximum(n[js], n[i]))]
        js = js[(sig[js] == sig[i]).sum(axis=1) >= MATCHES]
        if len(js):
            js = js[~np.isin(posted[js], posted[i][posted[i] >= 0]).any(axis=1)]
        if len(js):
            yield i, js


def _collisions(cells: DataFrame, classes: DataFrame, frequent) -> DataFrame:
    """The rows of cells whose class agrees with another of its cell in ``MATCHES`` coordinates."""
    def work(at, members):
        part, cls, label = (np.array(x, np.int64) for x in members[:3])
        sig = np.stack([np.frombuffer(x, np.uint32) for x in members[3]])
        found = np.zeros(len(cls), bool)
        for i, js in _candidates(at, part, label, sig, np.array(members[4]), _prefix(sig, *frequent.value)[0]):
            found[i] = found[js] = True
        rows = [np.full(int(found.sum()), k) for k in at] + [x[found] for x in (part, cls, label)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], names=list(_CELL))

    return _by_cell(cells.join(classes.select("cls", "sig", "n"), "cls"), ["sig", "n"], work,
                    ", ".join(f"{c} long" for c in _CELL), "collisions")


def _links_of_cells(cells: DataFrame, sets: DataFrame, frequent) -> DataFrame:
    """u, v: links between members of one cell, confirmed on full sets: a spanning forest of them."""
    def work(at, members):
        part, cls, label = (np.array(x, np.int64) for x in members[:3])
        sig = np.stack([np.frombuffer(x, np.uint32) for x in members[3]])
        sets = [np.frombuffer(x, np.uint64) for x in members[4]]
        n = np.array([len(s) for s in sets])
        items, code = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.cumsum(n) - n
        mark = np.zeros(len(items), np.int64)
        found = []
        for i, js in _candidates(at, part, label, sig, n, _prefix(sig, *frequent.value)[0]):
            mine = code[first[i]:first[i] + n[i]]
            mark[mine] = 1
            theirs = mark[np.concatenate([code[first[j]:first[j] + n[j]] for j in js])]
            shared = np.add.reduceat(theirs, np.cumsum(n[js]) - n[js])
            mark[mine] = 0
            for j in js[100 * shared >= PERCENT * (n[i] + n[js] - shared)]:
                if label[j] != label[i]:
                    found.append((cls[i], cls[j]))
                    label[label == label[j]] = label[i]
        p = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["u", "v"])

    return _by_cell(cells.join(sets.select("cls", "sig", "items"), "cls"), ["sig", "items"], work, "u long, v long", "links")


def _components(docs: DataFrame) -> DataFrame:
    """doc_id, tag, n_shingles, component, group of every row of docs (doc_id, text).

    tag is a hash of the text; component is the smallest id of the group, which
    two groups share if texts of both have that id.
    """
    signed = staged(_sign(docs).withColumn("cls", F.when(F.col("sig").isNotNull() & F.col("doc_id").isNotNull(),
                                                         F.xxhash64("f1", "f2", "n"))), "signed")
    classes = staged(signed.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.count(F.lit(1)).alias("copies")), "classes")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent_pairs(classes))
    lists = _posting_lists(classes, frequent)
    pairs = _star(lists)
    ends = pairs.select(F.col("u").alias("cls")).unionAll(pairs.select("v"))
    star = _verify(pairs, _needed_sets(docs, classes, ends))
    links = star.filter("link").select("u", "v")
    labels = connected(links)
    cells = _collisions(_open_members(lists, labels, star), classes, frequent)
    if not cells.isEmpty():
        more = _links_of_cells(cells, _needed_sets(docs, classes, cells.select("cls")), frequent)
        if not more.isEmpty():
            labels = connected(links.unionAll(more))
    linked = classes.select("cls", "rep").join(labels.withColumnRenamed("id", "cls"), "cls")
    best = linked.groupBy("label").agg(F.min("rep").alias("best"))
    of = linked.join(best, "label").select("cls", "label", "best")
    per = staged(classes.select("cls", "rep", "copies").join(of, "cls", "left").select(
        "cls", "copies", F.coalesce("best", "rep").alias("component"), F.coalesce("label", "cls").alias("group")), "components")
    # classes of many copies are at most HEAVY and sent to all tasks; the rest meet their rows by key
    rows = signed.select("doc_id", "tag", F.col("n").alias("n_shingles"), "cls")
    heavy = F.broadcast(per.filter(F.col("copies") * HEAVY > signed.count()).select("cls", "component", "group"))
    light = rows.filter(F.col("cls").isNotNull()).join(heavy, "cls", "left_anti").join(per.drop("copies"), "cls")
    alone = rows.filter(F.col("cls").isNull()).withColumn("component", F.col("doc_id")).withColumn("group", F.lit(None).cast("long"))
    columns = ["doc_id", "tag", "n_shingles", "component", "group"]
    return rows.join(heavy, "cls").select(columns).unionAll(light.select(columns)).unionAll(alone.select(columns))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs."""
    found = _components(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component; all columns kept.

    Rows are told apart by id and text: of a component the row with the
    smallest id stays, of several texts of that id the one with the smallest
    hash, and of equal rows of it (which differ in other columns at most) one.
    A row of the same id whose text is in another component is not touched,
    and rows without id all stay.
    """
    rows = staged(_components(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
                  .filter(F.col("doc_id").isNotNull()), "rows")
    some = rows.filter(F.col("group").isNotNull())
    best = some.groupBy("group").agg(F.min(F.struct("doc_id", "tag")).alias("b")).select("b.*")
    keys = [F.col("doc_id").alias("__dup_id"), F.col("tag").alias("__dup_tag")]
    away = some.join(best, ["doc_id", "tag"], "left_anti").select(*keys).distinct()
    same = (F.col(f"`{id_col}`") == F.col("__dup_id")) & (F.xxhash64(f"`{text_col}`") == F.col("__dup_tag"))
    kept = docs.join(away, same, "left_anti")
    twice = staged(some.groupBy("doc_id", "tag").count().filter("count > 1")
                   .join(best, ["doc_id", "tag"], "left_semi").select(*keys), "twice")
    if twice.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = (kept.join(twice, same, "left_semi").select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(f"`{text_col}`").alias("__tag"), row.alias("__row"))
            .groupBy("__id", "__tag").agg(F.min_by("__row", F.to_json("__row")).alias("__row")).select("__row.*"))
    return kept.join(twice, same, "left_anti").unionAll(once)
