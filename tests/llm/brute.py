"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall((text or "").translate(UP))


def alnum(text):
    return ALNUM.findall((text or "").translate(UP))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contaminated(texts, items, window=10):
    """Per text: words, hit words, items and whether any is hit."""
    wins = {}
    for item, text in items:
        w = alnum(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = {len(w) for w in wins}
    out = []
    for text in texts:
        w = alnum(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (got := wins.get(tuple(w[i:i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= got
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def shingles(text):
    w = spaced(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """(id, text) -> (id, shingles, component) of every row with an id."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(rows))


def base_scores(rows):
    """(id, text) -> (id, held_out, tokens, known, train tokens, base score)."""
    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    tokens = [(i, [*spaced(t), None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens]


def base_secrets(text):
    """(kind, start, end) of the fixed kinds, by start, then kind."""
    kinds = ("assign", "access", "hex")
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
        r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kinds[k], s, e) for s, k, e in sorted(found)]
