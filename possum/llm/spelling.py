"""Operator 11: spelling variants by neighbourhoods over a reduced alphabet.

1. Words are counted over all texts (native aggregation, combined before the
   shuffle).
2. Letters are hashed to ``SYMBOLS`` symbols. For every word the full one-edit
   neighbourhood of its reduced form is generated: the form itself, each
   symbol replaced, each deleted, each inserted anywhere. Two words one edit
   apart are one edit or none apart when reduced, so the reduced form of one is
   in the neighbourhood of the other.
3. The neighbourhoods are joined with the reduced forms of the vocabulary. An
   edit leaves one half of a word as it was: neighbours made by an edit behind
   the first half carry these letters, the others those of the last half, so
   only words that also agree there meet, and a group holds what differs in the
   other half alone. Neighbours that no word of the vocabulary has, by a bitmap
   of fixed size, are not sent: most of them.
4. The pairs that meet are verified on the original strings (edit distance 1)
   where they meet.

Reduced forms are compared by a polynomial hash, from which the hash of every
neighbour follows in constant time: the work is linear in the letters of the
vocabulary, also for words of a million letters. Words above ``LONG`` letters
meet by number and are verified afterwards, so that no row repeats a long word
for each of its neighbours. A chance meeting of hashes is undone by the
verification.

A word's form is its near word of largest count, if that is ``TIMES`` the
word's own. Counts grow by that factor along a chain of forms, so at most
log(largest count) hops lead to the root, and pointer jumping needs the
logarithm of that.

Nulls and odd input: a null or wordless text has no words; a row without id
counts with the id text ``null``; repeated rows count again; an empty table has
no words. Other columns of the table play no part, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from possum.llm.staging import staged
from possum.llm.tasks import arrow_map
from possum.llm.words import U, mix

MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10
SYMBOLS = 4
DROP = 31              # a run loses a letter if this divides its checksum
LONG = 64              # letters
SLICE = 1 << 16        # letters of one step of the neighbourhood generation
BITS = 1 << 27         # of the bitmap of the vocabulary's keys, 16 MB
_B = 0x9E3779B97F4A7C15
_B_INV = pow(_B, -1, 1 << 64)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the letter runs of all texts, some of which lose a letter.

    Runs shorter than ``min_length`` can't become words and are not listed.
    """
    low = F.translate(F.col("text"), _UPPER, _UPPER.lower())
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("i"),
        F.explode(F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), 0)).alias("run"))
    h = runs.select("run", F.crc32(F.concat("i", F.lit(":"), "run")).alias("h"), F.length("run").alias("l"))
    at = (F.col("h") % F.col("l")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("l")))
    words = h.select(F.when(F.col("h") % DROP == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def symbol(code: np.ndarray) -> np.ndarray:
    """1 to SYMBOLS for each code point."""
    table = np.array([zlib.crc32(chr(c).encode()) % SYMBOLS + 1 for c in range(256)], np.uint64)
    return table[np.minimum(code, 255)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_B, _B_INV):
        t = np.full(n, U(base))
        t[0] = 1
        out.append(np.cumprod(t, dtype=np.uint64))
    return out[0], out[1]


def _key(value: np.ndarray, head: np.ndarray) -> np.ndarray:
    """A 48-bit key whose last bit tells which half it holds (0: the first)."""
    return (mix(value) >> U(17) << U(1)) | (~head).astype(np.uint64)


def _spans(code: np.ndarray, first: np.ndarray, size: np.ndarray, power: np.ndarray, inverse: np.ndarray) -> Callable:
    """Hash of the letters i to j (word by word) of the words ``w``."""
    place = np.arange(len(code)) - np.repeat(first, size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((code + U(1)) * power[place], dtype=np.uint64)])

    def span(w: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return mix((total[first[w] + j] - total[first[w] + i]) * inverse[i])

    return span


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the words in a row, and where each word starts."""
    text = "".join(words.to_pylist())
    sizes = np.asarray(pc.utf8_length(words), np.int64)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def neighbourhood(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word number, key) of every neighbour of every word; words have at least 3 letters."""
    code, at = _letters(words)
    first, size = at[:-1], np.diff(at)
    s = symbol(code)
    power, inverse = _powers(int(size.max()) + 2)
    span = _spans(code, first, size, power, inverse)
    # gaps: one before each letter and one behind the last
    who = np.repeat(np.arange(len(size)), size + 1)
    p = np.arange(len(who)) - np.repeat(first + np.arange(len(size)), size + 1)
    letter = np.minimum(first[who] + p, len(code) - 1)
    place = np.arange(len(code)) - np.repeat(first, size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s * power[place], dtype=np.uint64)])
    whole = (total[at[1:]] - total[first])[who]
    before = total[first[who] + p] - total[first[who]]       # the p letters before the gap
    inside = p < size[who]
    here = np.where(inside, s[letter], U(0))
    left = np.where(p == 0, U(0), s[np.maximum(first[who] + p - 1, 0)])
    behind = whole - before                                  # the letters from the gap on
    step = power[p]
    keys, owners = [], []

    ends = {}
    for more in (-1, 0, 1):     # the letters that neighbours of this many letters more must share, and where either share of the gaps starts
        half = ((size + more - 1) // 2)[who]
        head = p >= half
        n = size[who]
        span_of = span(who, np.where(head, 0, n - half), np.where(head, half, n))
        ends[more] = (span_of ^ np.where(head, U(0), U(_B)), head, (p == 0) | (p == half))

    def add(more: int, use: np.ndarray, value: np.ndarray) -> None:
        keys.append(_key(value[use] ^ ends[more][0][use], ends[more][1][use]))
        owners.append(who[use])

    add(0, ends[0][2], whole)
    add(-1, inside & (ends[-1][2] | (left != here)), before + (behind - here * step) * inverse[1])
    for c in range(1, SYMBOLS + 1):
        add(0, inside & (here != U(c)), whole + (U(c) - here) * step)
        add(1, ends[1][2] | (left != U(c)), before + U(c) * step + behind * power[1])
    return np.concatenate(owners), np.concatenate(keys)


def reduced(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word number, key): each word's reduced form, once with either end."""
    code, at = _letters(words)
    first, size = at[:-1], np.diff(at)
    power, inverse = _powers(int(size.max()) + 2)
    span = _spans(code, first, size, power, inverse)
    place = np.arange(len(code)) - np.repeat(first, size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbol(code) * power[place], dtype=np.uint64)])
    whole = total[at[1:]] - total[first]
    n, half = np.arange(len(size)), (size - 1) // 2
    head, tail = span(n, 0 * n, half), span(n, size - half, size)
    yes = np.ones(len(size), bool)
    return np.concatenate([n, n]), np.concatenate([_key(whole ^ head, yes), _key(whole ^ tail ^ U(_B), ~yes)])


def _keyed(vocabulary: DataFrame, make: Callable, send: list[str], present: np.ndarray | None = None) -> DataFrame:
    """key and the columns ``send`` for what ``make`` gives for the words (the
    first column), a bounded number of letters at a time.

    ``present`` is a bitmap of the keys worth sending.
    """
    def task(batches):
        for b in batches:
            words = b.column(0)
            size = np.concatenate([[0], np.cumsum(np.asarray(pc.utf8_length(words), np.int64))])
            i = 0
            while i < len(words):
                j = max(i + 1, int(np.searchsorted(size, size[i] + SLICE, "right")) - 1)
                who, key = make(words.slice(i, j - i))
                if present is not None:
                    slot = (key >> U(1)) & U(BITS - 1)
                    some = (present[slot >> U(3)] >> (slot & U(7)).astype(np.uint8)) & 1 == 1
                    who, key = who[some], key[some]
                for k in range(0, max(1, len(who)), 1 << 18):
                    rows = pa.array(i + who[k:k + (1 << 18)])
                    yield pa.RecordBatch.from_arrays([pa.array(key[k:k + (1 << 18)].view(np.int64)), *[c.take(rows) for c in b.columns[1:]]],
                                                     names=["key", *b.schema.names[1:]])
                i = j

    sent = vocabulary.select(F.col(vocabulary.columns[0]).alias("__word"), *send)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sent.schema.fields[1:])
    return arrow_map(sent, task, f"key long, {kinds}")


def _present(keys: DataFrame) -> np.ndarray:
    """Bitmap of the keys, BITS long: at most BITS / 32768 rows of 4 kB come to the driver, whatever the vocabulary."""
    slot = F.shiftright("key", 1).bitwiseAND(F.lit(BITS - 1))
    # the functions count positions from 1
    rows = (keys.select(F.bitmap_bucket_number(slot + 1).alias("bucket"), F.bitmap_bit_position(slot + 1).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for bucket, bits in rows:
        at = (bucket - 1) * 4096
        out[at:at + 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, near, near_n: all ordered pairs of the vocabulary (word, n) that are one edit apart.

    Words must be distinct and have at least 3 letters; pass a staged frame.
    """
    one_edit = F.levenshtein("word", "near", 1) == 1
    short = vocabulary.where(F.length("word") <= LONG)
    posted = staged(_keyed(short.select(F.col("word").alias("near"), F.col("n").alias("near_n")), reduced, ["near", "near_n"]), "reduced")
    met = _keyed(short, neighbourhood, ["word"], _present(posted)).join(posted, "key")
    # each pair once: by its first half if the two share it, or else by its last
    half = ((F.length("near") - 1) / 2).cast("int")
    same = F.substring(F.col("word"), F.lit(1), half) == F.substring(F.col("near"), F.lit(1), half)
    pairs = met.where(one_edit & (same == (F.col("key").bitwiseAND(F.lit(1)) == 0))).select("word", "near", "near_n")
    # long words, and their near words of LONG letters
    long = vocabulary.where(F.length("word") >= LONG).select("word", F.xxhash64("word").alias("id"), "n")
    left = long.select("word", F.col("id").alias("a"))
    right = long.select(F.col("word").alias("near"), F.col("id").alias("b"), F.col("n").alias("near_n"))
    numbers = _keyed(left, neighbourhood, ["a"]).join(_keyed(right, reduced, ["b"]), "key").select("a", "b").distinct()
    others = numbers.join(left, "a").join(right, "b").where(one_edit & (F.greatest(F.length("word"), F.length("near")) > LONG))
    return pairs.unionByName(others.select("word", "near", "near_n"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root of every word with a form, by pointer jumping; most is the largest count."""
    hops = max(1, int(math.log(max(most, 1), TIMES)) + 1)
    chain = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        nxt = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = staged(chain.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return chain


def variants(vocabulary: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n)."""
    rows = vocabulary.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    near = near_words(vocabulary).select("word", F.lit(None).cast("long").alias("n"), "near", "near_n")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), "near"))).alias("best")
    g = rows.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best)
    has = -F.col("best.m") >= times * F.col("n")
    g = staged(g.select("word", "n", "n_near", F.when(has, F.col("best.near")).alias("form"),
                        F.when(has, -F.col("best.m")).alias("form_n")), "forms")
    # one small aggregate bounds the number of hops
    most = g.agg(F.coalesce(F.max("n"), F.lit(1)).alias("m")).first()["m"]
    out = g.join(_roots(g.where(F.col("form").isNotNull()), most), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Every word of the texts with its form, root and counts."""
    return variants(staged(word_counts(docs), "vocabulary"))
