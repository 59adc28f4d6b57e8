"""Properties: the column expressions agree with plain-Python semantics on
random inputs (the reference reshapes rows in Python)."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from possum.functions import codes
from possum.functions.dates import day_key_to_iso
from possum.functions.text import ustrip
from possum.operators.people import _python_int

SETTINGS = settings(max_examples=15, deadline=None, derandomize=True)
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
# item codes: no line terminators inside (ASCII-digit contract, see codes.py)
CODE_CHARS = "0123456789abcWSXyz" + " \t"


def _col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r.o for r in df.select(fn(F.col("v")).alias("o")).collect()]


@SETTINGS
@given(st.lists(st.text(alphabet=SPACES + "ab c", max_size=8), min_size=1, max_size=30))
def test_ustrip_is_python_strip(spark, values):
    assert _col(spark, values, ustrip) == [v.strip() for v in values]


def _py_iso(k: str) -> str:
    try:
        dd, mm, yy = k.split("/")
    except ValueError:
        return k
    return f"{yy}-{mm.zfill(2)}-{dd.zfill(2)}"


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789/+-x", max_size=12), min_size=1, max_size=30))
def test_day_keys_like_python(spark, values):
    assert _col(spark, values, day_key_to_iso) == [_py_iso(v) for v in values]


CODE = re.compile(r"^(\d{2})([A-Za-z]+)(\d{2})([A-Za-z0-9]{2})(.+)$", re.ASCII)


def _py_code(v, g):
    m = CODE.match(str(v or "").strip())
    return m.group(g) if m else ""


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=CODE_CHARS, max_size=14),
                          st.from_regex(r"\A[0-9]{2}[A-Za-z]{1,3}[0-9]{2}[A-Za-z0-9]{2}[A-Za-z0-9]{0,3}\Z")),
                min_size=1, max_size=30))
def test_code_parts_like_python(spark, values):
    assert _col(spark, values, codes.model_code) == [_py_code(v, 4) for v in values]
    assert _col(spark, values, codes.size_code) == [_py_code(v, 5) for v in values]


def _py_int(v):
    try:
        n = int(v)
    except ValueError:
        return None
    return n if -2**31 <= n < 2**31 else None


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789_+- \t", max_size=8), min_size=1, max_size=30))
def test_store_code_int_like_python(spark, values):
    assert _col(spark, values, _python_int) == [_py_int(v) for v in values]


# --- D6 against a brute force written from the specification ---------------
# fixed values: code prefixes of the imputation levels
LEVELS = (re.compile(r"^(\d{2}[A-Za-z]+\d{2}[A-Za-z0-9]{2})", re.ASCII),
          re.compile(r"^\d{2}([A-Za-z]+\d{2}[A-Za-z0-9]{2})", re.ASCII),
          re.compile(r"^\d{2}[A-Za-z]+(\d{2}[A-Za-z0-9]{2})", re.ASCII))


def _brute_impute(items: dict[str, tuple[str, int]]) -> dict[str, int]:
    """items: key -> (code, cost). Level maps from observed costs only; a zero
    cost takes the first level whose prefix has a known maximum."""
    def prefix(code, lvl):
        m = LEVELS[lvl].match(code.strip())
        return m.group(1) if m else None
    best = [{} for _ in LEVELS]
    for code, cost in items.values():
        for lvl in range(3):
            pre = prefix(code, lvl)
            if cost > 0 and code and pre is not None:
                best[lvl][pre] = max(best[lvl].get(pre, 0), cost)
    out = {}
    for key, (code, cost) in items.items():
        hits = [best[lvl].get(prefix(code, lvl)) for lvl in range(3)] if cost == 0 and code else []
        out[key] = next((h for h in hits if h), cost)
    return out


CODES = st.builds(lambda y, s, m, c, z: f"{y}{s}{m}{c}{z}",
                  st.sampled_from(["24", "25"]), st.sampled_from(["W", "w", "S", "SW"]),
                  st.sampled_from(["03", "04"]), st.sampled_from(["03", "0a", "0A"]),
                  st.sampled_from(["M1", "L2", "X"]))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(CODES, st.sampled_from(["", "180", " 25W0303M1 "])),
                          st.sampled_from([0, 0, 3, 5, 9])), min_size=1, max_size=25))
def test_impute_like_brute_force(spark, rows):
    from decimal import Decimal
    from possum.operators.pricing import impute_cost
    items = {f"k{i}": r for i, r in enumerate(rows)}
    df = spark.createDataFrame(
        [("main", k, "n", code, "", "", Decimal(cost), {}, Decimal(1)) for k, (code, cost) in items.items()],
        "branch string, key string, n string, b string, mn string, d string, p decimal(18,2), "
        "s map<string,decimal(18,1)>, q decimal(18,1)")
    got = {r.key: int(r.p) for r in impute_cost(df).collect()}
    assert got == _brute_impute(items)


# --- D5 against a brute force written from the specification ---------------
def _brute_catalogue(lines):
    """lines: (item_id, row_id, name, barcode, store, qty, price). Group by key, then reduce each group."""
    def key_of(line):
        return (line[3] or "").strip() or line[2]

    out = {}
    for key in {key_of(x) for x in lines}:
        group = sorted((x for x in lines if key_of(x) == key), key=lambda x: x[:2])
        lowest = group[0]
        out[key] = {"n": lowest[2], "b": lowest[3] or "", "q": sum(x[5] for x in group),
                    "p": max(x[6] or 0 for x in group),
                    "s": {store: [x[5] for x in group if x[4] == store][-1] for store in {x[4] for x in group}}}
    return out


LINES = st.lists(st.tuples(st.integers(1, 6), st.integers(1, 3), st.sampled_from(["x", "y", " z"]),
                           st.sampled_from(["", " ", "B1", "B1 ", "B2", None]),
                           st.sampled_from(["S1", "S2"]), st.integers(1, 9), st.sampled_from([None, 0, 4, 7])),
                 min_size=1, max_size=20, unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(LINES)
def test_catalogue_like_brute_force(spark, lines):
    from decimal import Decimal
    from possum.operators.stock import item_catalogue
    df = spark.createDataFrame(
        [("main", i, r, r, n, b, "m", s, Decimal(q), "d", None if p is None else Decimal(p))
         for i, r, n, b, s, q, p in lines],
        "branch string, ItemID long, OnHandRowID long, AttrRowID long, Name string, BarcodeNumber string, "
        "ModelNumber string, StoreNameOrig string, Qty decimal(18,1), Department string, Price decimal(18,2)")
    got = {r.key: {"n": r.n, "b": r.b, "p": int(r.p), "s": {k: int(v) for k, v in r.s.items()}, "q": int(r.q)}
           for r in item_catalogue(df).collect()}
    assert got == _brute_catalogue(lines)


# --- D20 against a brute force written from the specification --------------
PUNCH = st.one_of(st.none(), st.tuples(st.integers(0, 23), st.integers(0, 59)))


@SETTINGS
@given(st.lists(st.lists(st.tuples(PUNCH, PUNCH), min_size=6, max_size=6), min_size=1, max_size=8))
def test_attendance_like_brute_force(spark, days):
    from datetime import datetime
    import frames
    from possum.operators.attendance import attendance
    from possum.rules import Rules

    def ts(p):
        return None if p is None else f"2024-01-10 {p[0]:02d}:{p[1]:02d}:00"
    pv = []
    want = {}
    for uid, pairs in enumerate(days, 1):
        row = {"UserID": uid, "Name": "u", "UserNo": str(uid), "StoreID": 1, "PreDate": "2024-01-10"}
        for i, (a, b) in enumerate(pairs, 1):
            row[f"Login{i}"], row[f"Logout{i}"] = ts(a), ts(b)
        pv.append(row)
        kept = [(a, b) for a, b in pairs if a is not None or b is not None]
        if kept:
            mins = sum(((b[0] * 60 + b[1]) - (a[0] * 60 + a[1])) % 1440 for a, b in kept
                       if a is not None and b is not None)
            want[str(uid)] = (round(mins / 60.0, 2),
                              [(None if a is None else f"{a[0]:02d}:{a[1]:02d}",
                                None if b is None else f"{b[0]:02d}:{b[1]:02d}") for a, b in kept])
    bundle = frames.bundle(spark, store=[frames.STORE], presence_view=pv)
    got = {r.uid: (r.hours, [tuple(p) for p in r.punches])
           for r in attendance(bundle, Rules(), datetime(2024, 1, 30)).collect()}
    assert got == want


# --- D22 against a brute force written from the specification --------------
@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(1, 5), st.sampled_from(["", "P", "Q"]),
                          st.sampled_from(["2024-01", "2024-02"]), st.sampled_from(["S1", "S2"]),
                          st.integers(0, 5), st.integers(0, 50)), min_size=1, max_size=20))
def test_promotion_matrix_like_brute_force(spark, rows):
    from decimal import Decimal
    import frames
    from possum.operators.branches import union_branches
    from possum.operators.promotions import promotion_matrix
    from possum.rules import Rules
    rules = Rules()
    order = {"A": 0, "B": 1}
    want: dict = {}
    for br, pid, name, ym, store, qty, total in sorted(rows, key=lambda r: (order[r[0]], r[1])):
        key = name or f"{rules.promotion_prefix}{pid}"
        e = want.setdefault(key, {"id": pid, "name": name, "m": {}, "t": 0})
        cell = e["m"].setdefault(ym, {}).setdefault(store, [0, 0])
        cell[0] += qty
        cell[1] += total
        e["t"] += total
    red = spark.createDataFrame([(br, pid, name, ym, store, Decimal(q), Decimal(t))
                                 for br, pid, name, ym, store, q, t in rows],
                                "branch string, id int, name string, ym string, store string, "
                                "qty decimal(18,1), total decimal(18,2)")
    bundle = union_branches([(frames.bundle(spark, "A"), None), (frames.bundle(spark, "B"), None)])
    got = {r.key: {"id": r.id, "name": r.name, "t": int(r.promo_total),
                   "m": {ym: {s: [int(v.qty), int(v.total)] for s, v in cells.items()}
                         for ym, cells in r.monthly.items()}}
           for r in promotion_matrix(red, bundle, rules).collect()}
    assert got == want


# --- M3 against a brute force written from the specification ---------------
@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["x", "y"]), st.integers(0, 9),
                          st.integers(0, 3), st.text(alphabet="abc", max_size=2)),
                min_size=1, max_size=20, unique_by=lambda t: (t[0], t[1], t[3])))
def test_merge_sum_like_brute_force(spark, rows):
    from possum.operators.branches import merge_sum
    want = {}
    for day, name, amount, rank, other in sorted(rows, key=lambda r: r[3]):
        e = want.setdefault((day, name), [0, other])   # first row in rank order keeps its fields
        e[0] += amount
    df = spark.createDataFrame(rows, "day string, name string, amount long, rank int, other string")
    got = {(r.day, r.name): [r.amount, r.other]
           for r in merge_sum(df, ["day", "name"], ["amount"], ["rank"]).collect()}
    assert got == want


# --- M4 against a brute force written from the specification ---------------
@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["u1", "u2", "u3"]),
                          st.sampled_from(["h1", "h2"]), st.sampled_from(["1", "2", "3"]),
                          st.sampled_from(["x", "y", "z"])),
                min_size=1, max_size=20, unique_by=lambda t: (t[0], t[1], t[2], t[3])))
def test_dedupe_first_like_brute_force(spark, rows):
    import frames
    from possum.operators.branches import union_branches
    from possum.operators.people import dedupe_first
    order = {"B": 0, "A": 1}                       # B is configured first
    want = {}
    for br, user, h, no, display in sorted(rows, key=lambda r: (order[r[0]], r[3])):
        want.setdefault((user, h), (br, no, display))
    df = spark.createDataFrame(rows, "branch string, user string, hash string, no string, display string")
    bundle = union_branches([(frames.bundle(spark, "B"), None), (frames.bundle(spark, "A"), None)])
    got = {(r.user, r.hash): (r.branch, r.no, r.display)
           for r in dedupe_first(df, bundle, ["user", "hash"], ["no"]).collect()}
    assert got == want
