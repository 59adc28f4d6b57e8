"""Operator 10: secret scan by password guess cost.

Three fixed kinds of span are found by pattern (``assign``, ``access``,
``hex``). The method adds a fourth, ``guess``: values that stand in a
credential context and that a guesser would need at least
``10 ** MIN_GUESSES`` tries for, unless other spans cover them whole. The number of tries is the cheapest way to
cut the value into common words, dates, repeats, keyboard walks or sequences,
and brute-force characters, found by dynamic programming over its positions.
After ``:`` and ``=`` the cost alone decides; after ``is`` a plain word is prose.

A guesser knows the words people write: the corpus' most frequent words, by a
count over all texts, stand beside a few words that passwords are made of. Values in credential
contexts take no part in the count, so a secret that stands in many copies of
a text does not make itself a common word. The dictionary holds ``WORDS`` words
of at most ``LONGEST`` letters that occur ``LEAST`` times or more; this bound
is a parameter of the guesser, and no text or value is left out by it.

Whole texts are scanned. Bytes decide first which texts can hold a span at
all; only those are read as strings, so offsets are code points.

Nulls and odd input: a null or empty text has no spans; a value of any length
is costed whole, in time linear in it; repeated rows are scanned one by one;
an empty table gives no rows; columns other than id and text pass through
``redact`` untouched.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from possum.llm.staging import staged
from possum.llm.tasks import arrow_map
from possum.llm.words import LOWER, chunks, runs, split

KINDS = ("assign", "access", "hex", "guess")
MIN_GUESSES = 7.0
WORDS = 1 << 15
LONGEST = 24
LEAST = 3
_FLUSH = 200_000
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|bearer|auth|credentials?|api[_-]?key"""
    r"""|(?:private|access|client|secret)[_-]?(?:key|secret))["']?\x20*(:=|=>|[:=]|\bis\b)\x20*["']?"""
    r"""([^\s"'<>]+)""", re.ASCII | re.IGNORECASE)
_HINTS = (b"pass", b"pwd", b"pin", b"secret", b"token", b"bearer", b"auth", b"credential", b"key")

# fixed values: words that passwords are often made of, most frequent first
COMMON_WORDS = (
    "password", "admin", "welcome", "login", "letmein", "monkey", "dragon", "master", "love", "secret", "hello",
    "sunshine", "princess", "football", "baseball", "shadow", "superman", "batman", "trust", "pass", "user", "root",
    "test", "guest", "default", "changeme", "summer", "winter", "spring", "autumn", "access", "server", "system",
    "freedom", "whatever", "computer", "internet", "flower", "cookie", "killer", "happy", "angel", "money", "tiger")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("4@83105$7", "aabelossT".lower())
_STEP = math.log10(2)  # each further span doubles the tries
_YEAR = re.compile(r"(?:19|20)\d\d", re.ASCII)
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d", re.ASCII)


def _keyboard() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for r, row in enumerate(KEY_ROWS):
        for c, key in enumerate(row):
            at = near.setdefault(key, set())
            for rr, cc in ((r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c), (r + 1, c - 1)):
                if 0 <= rr < len(KEY_ROWS) and 0 <= cc < len(KEY_ROWS[rr]):
                    at.add(KEY_ROWS[rr][cc])
    return near


_NEAR = _keyboard()
class Dictionary:
    """Words and their ranks, 1 for the most frequent."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.heads = {w[:3] for w in ranks}


PASSWORD_WORDS = Dictionary({w: i + 1 for i, w in enumerate(COMMON_WORDS)})
_byte = np.arange(256)
_LETTER = ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)


def _brute(ch: str) -> float:
    if "0" <= ch <= "9":
        return 1.0
    return math.log10(26) if ch.isalpha() else math.log10(33)


def _case(s: str) -> float:
    ups = sum(c.isupper() for c in s)
    return 0.0 if not ups else _STEP if ups == len(s) or (ups == 1 and s[0].isupper()) else ups * 2 * _STEP


def guess_cost(value: str, words: Dictionary = PASSWORD_WORDS) -> float:
    """log10 of the tries the cheapest segmentation of value needs; 0 for ""."""
    n = len(value)
    low = value.lower()
    if len(low) != n:  # a letter whose lower case is longer
        low = value
    plain = low.translate(_LEET)
    best = [0.0] + [math.inf] * n
    brute = math.inf          # of plans whose last span, brute force, ends here
    walk = run_up = run_down = (math.inf,) * 3  # of plans ending in 1, 2, 3 or more keys of a walk or run
    for i in range(n):
        base = best[i] + (_STEP if i else 0.0)

        def offer(j: int, cost: float, base: float = base) -> None:
            best[j] = min(best[j], base + cost)

        def longer(run: tuple, goes_on: bool, start: float, step: float, base: float = base) -> tuple:
            if not goes_on:
                return base + start, math.inf, math.inf
            return base + start, run[0] + step, min(run[1], run[2]) + step

        if low[i:i + 3] in words.heads or plain[i:i + 3] in words.heads:
            for j in range(i + 3, min(n, i + words.longest) + 1):  # words, also with digits for letters
                if (rank := words.ranks.get(low[i:j])) is not None:
                    offer(j, math.log10(rank) + _case(value[i:j]))
                if (rank := words.ranks.get(plain[i:j])) is not None:
                    offer(j, math.log10(rank) + 2 * _STEP + _case(value[i:j]))
        if "0" <= value[i] <= "9":  # dates and years
            if m := _DATE.match(value, i):
                offer(m.end(), math.log10(119 * 365 * 4))
            if _YEAR.match(value, i):
                offer(i + 4, math.log10(119))
        for unit in (1, 2, 3, 4):  # repeats of a short unit
            j, cost = i + unit, sum(map(_brute, value[i:i + unit]))
            while value[j:j + unit] == value[i:i + unit] and j + unit <= n:
                j += unit
                if 3 <= j - i <= 64:
                    offer(j, cost + math.log10((j - i) / unit))
                if j - i > 16 and i > unit and value[i - unit:i] == value[i:i + unit]:
                    break  # inside a long repeat, whose first unit has gone to its end
            if j - i > 64:
                offer(j, cost + math.log10((j - i) / unit))
        # keyboard walks, and runs like abc or 321
        walk = longer(walk, i > 0 and low[i] in _NEAR.get(low[i - 1], ()), math.log10(47), _STEP)
        step = ord(low[i]) - ord(low[i - 1]) if i else 0
        run_up = longer(run_up, step == 1, math.log10(52), _STEP / 2)
        run_down = longer(run_down, step == -1, math.log10(52), _STEP / 2)
        brute = min(brute, base) + _brute(value[i])
        best[i + 1] = min(best[i + 1], walk[2], run_up[2], run_down[2], brute)
    return best[n]


class Span(NamedTuple):
    start: int
    end: int
    kind: int      # index in KINDS
    value: int     # where the secret itself starts
    guesses: float  # log10 tries of the value; nan for access and hex


def _covered(start: int, end: int, spans: list[Span]) -> bool:
    """Whether the spans, sorted by start, cover all of start to end."""
    for s in spans:
        if s.start > start or start >= end:
            break
        start = max(start, s.end)
    return start >= end


def scan(text: str, min_guesses: float = MIN_GUESSES, words: Dictionary = PASSWORD_WORDS) -> list[Span]:
    """All spans of a text, by start, then kind."""
    found = [Span(m.start(), m.end(), 0, m.start(2), guess_cost(m[2], words))
             for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [Span(m.start(), m.end(), 1, m.start(), math.nan) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [Span(m.start(), m.end(), 2, m.start(), math.nan) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    found.sort()
    base = list(found)
    for m in CONTEXT.finditer(text):
        value = m[2].rstrip(".,;:!?)]}")
        start, end = m.start(2), m.start(2) + len(value)
        if _covered(start, end, base):
            continue
        if m[1].lower() == "is" and value.replace("-", "").isalpha():
            continue
        if (cost := guess_cost(value, words)) >= min_guesses:
            found.append(Span(start, end, 3, start, cost))
    return sorted(found)


def _suspects(texts: pa.Array):
    """Per chunk: rows i to j and which of them can hold a span, from their bytes."""
    is_hex = np.zeros(256, np.uint8)
    is_hex[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = 1
    for i, j, data, offs in chunks(texts):
        starts, ends = runs(is_hex[data], offs)
        row = np.zeros(j - i, bool)
        row[np.searchsorted(offs, starts[ends - starts >= 24], "right") - 1] = True
        raw, low = data.tobytes(), LOWER[data].tobytes()
        for where, hint in [(raw, b"AKIA"), *((low, h) for h in _HINTS)]:
            at = where.find(hint)
            while at >= 0:
                k = int(np.searchsorted(offs, at, "right")) - 1
                row[k] = True
                at = where.find(hint, int(offs[k + 1]))
        yield i, j, row, raw, offs


def _spans_of(texts: pa.Array, min_guesses: float, words: Dictionary):
    for i, j, row, raw, offs in _suspects(texts):
        for k in range(j - i):
            text = raw[offs[k]:offs[k + 1]].decode() if row[k] else ""
            yield text, scan(text, min_guesses, words) if row[k] else []


def _without_values(text: str) -> str:
    for pattern in (CONTEXT, ASSIGN):
        text = pattern.sub(" ", text)
    return text


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n: how often each word of 3 to ``LONGEST`` letters, in lower case, stands in the texts outside credential values."""
    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def task(batches):
        held: dict[str, int] = {}
        for b in batches:
            for i, j, row, raw, offs in _suspects(b.column(0)):
                parts = [raw[offs[k]:offs[k + 1]] for k in range(j - i)]
                for k in np.flatnonzero(row):
                    parts[k] = _without_values(parts[k].decode()).encode()
                data = np.frombuffer(b" ".join(parts), np.uint8)
                w = split(data, np.array([0, len(data)]), _LETTER)
                _, first, n = np.unique(w.hashes, return_index=True, return_counts=True)
                low = LOWER[data].tobytes()
                for at, to, many in zip(w.starts[first].tolist(), w.ends[first].tolist(), n.tolist(), strict=True):
                    if to - at <= 4 * LONGEST and 3 <= len(word := low[at:to].decode().lower()) <= LONGEST:
                        held[word] = held.get(word, 0) + many
                if len(held) > _FLUSH:
                    yield rows(held)
                    held = {}
        yield rows(held)

    return arrow_map(docs.select(text_col), task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corpus_dictionary(docs: DataFrame, text_col: str = "text", size: int = WORDS, least: int = LEAST) -> Dictionary:
    """The texts' most frequent words, at most ``size``, by rank (ties in code-point order), with ``COMMON_WORDS`` at their own ranks or better.

    Words whose counts lie within a sixteenth of a doubling enter together or not at all.
    """
    counts = staged(word_counts(docs, text_col).filter(F.col("n") >= least), "words")
    near = F.floor(F.log2("n") * 16)
    left, lowest = size, None
    for k, many in sorted(counts.groupBy(near.alias("k")).count().collect(), reverse=True):  # 16 * 64 rows at most
        left -= many
        if left < 0:
            break
        lowest = k
    rows = counts.filter(near >= lowest).collect() if lowest is not None else []  # size rows at most
    ranks = {r.word: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r.n, r.word)))}
    return Dictionary({**ranks, **{w: min(r, ranks.get(w, r)) for w, r in PASSWORD_WORDS.ranks.items()}})


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_guesses: float = MIN_GUESSES, words: Dictionary | None = None) -> DataFrame:
    """Per document: id, spans array<struct<kind, start, end, value_start, log10_guesses>>.

    ``words`` is the guesser's dictionary; by default that of ``docs``.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(words or corpus_dictionary(docs))
    span = T.StructType.fromDDL("kind string, start long, end long, value_start long, log10_guesses double")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("spans", T.ArrayType(span))])

    def task(batches):
        for b in batches:
            rows = [[{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "value_start": s.value,
                      "log10_guesses": None if math.isnan(s.guesses) else s.guesses} for s in spans]
                    for _, spans in _spans_of(b.column(1), min_guesses, shared.value)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                       ("value_start", pa.int64()), ("log10_guesses", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return arrow_map(docs, task, schema)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]",
           min_guesses: float = MIN_GUESSES, words: Dictionary | None = None) -> DataFrame:
    """docs with each secret value replaced by ``mark``; other texts and columns as they were.

    ``words`` is the guesser's dictionary; by default that of ``docs``.
    """
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(words or corpus_dictionary(docs, text_col))

    def task(batches):
        for b in batches:
            out = []
            for text, spans in _spans_of(b.column(place), min_guesses, shared.value):
                parts, at = [], 0
                for s in sorted(spans, key=lambda s: (s.value, s.end)):
                    if s.value >= at:
                        parts += [text[at:s.value], mark]
                    at = max(at, s.end)
                out.append("".join([*parts, text[at:]]) if spans else None)
            if any(x is not None for x in out):
                old = b.column(place)
                kind = old.type
                fixed = pa.array([x is not None for x in out])
                new = pc.if_else(fixed, pa.array(out, kind), old)
                b = b.set_column(place, b.schema.field(place), new)
            yield b

    return arrow_map(docs, task, docs.schema)


def secret_digest(spans: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, base_sha256, spans as text, from ``secret_spans``."""
    def joined(x):
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return spans.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count("guess").alias("n_guess"),
                        F.array_max(F.transform("spans", lambda s: s["log10_guesses"])).alias("max_log10_guesses"))
