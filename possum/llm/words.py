"""Vectorised word hashing over Arrow text columns.

Texts are read where Arrow keeps them, as one UTF-8 byte buffer; words are
found and hashed with numpy, so no Python string is made per word. Both word
patterns used by the operators of this package end at ASCII characters only,
so they can be read byte by byte: every byte of a longer UTF-8 sequence is a
word byte.

A word's hash is a polynomial in its lower-cased bytes modulo 2**64 with a
fixed odd base, passed through a 64-bit finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_byte = np.arange(256)
LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)
#: ``[^\\x20\\x09-\\x0D]+``: what stands between ASCII white space.
SPACED = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.
ALNUM = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)


class Words(NamedTuple):
    hashes: np.ndarray  # uint64 per word
    starts: np.ndarray  # byte offsets in the chunk
    ends: np.ndarray
    first: np.ndarray   # index of each document's first word, and the total


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; x is a uint64 array."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("pow", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("pow", _BASE), ("inv", _INVERSE)):
            t = np.full(size, U(base))
            t[0] = 1
            _tables[name] = np.cumprod(t, dtype=np.uint64)
    return _tables["pow"], _tables["inv"]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j with their bytes and byte offsets; null texts are empty.

    A chunk holds whole texts of ``limit`` bytes together, or one longer text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(arr)
    if not n:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def runs(kind: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of equal, non-zero classes in a text."""
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.empty(n + 1, bool)
    edge[0] = edge[n] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
    edge[offs] = True
    return (np.flatnonzero(edge[:n] & (kind != 0)),
            np.flatnonzero(edge[1:] & (kind != 0)) + 1)


def hash_spans(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + U(1)) * power[:len(low)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def split(data: np.ndarray, offs: np.ndarray, word: np.ndarray = SPACED) -> Words:
    """The words of the texts in one chunk, lower-cased (A-Z only) and hashed."""
    low = LOWER[data]
    starts, ends = runs(word[low].view(np.uint8), offs)
    return Words(hash_spans(low, starts, ends), starts, ends, np.searchsorted(starts, offs))


def hash_word(word: str) -> int:
    """The hash ``split`` gives to one word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(hash_spans(LOWER[raw], np.array([0]), np.array([len(raw)]))[0])
