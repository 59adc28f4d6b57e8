from __future__ import annotations

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from possum.llm import credentials
from possum.llm.credentials import guess_cost, redact, scan, secret_digest, secret_spans
from tests.llm.brute import base_secrets, sha

TEXTS = [None, "", "nothing here", "password = hunter22 and PassWd: abc", "api_key=\"AKIA" + "Z" * 18 + "\" token:deadbeef",
         "é\U0001f600 token = \"0123456789abcdef01234567\" x", "a" * 24 + " " + "b" * 23, "AKIA" + "0" * 15 + " AKIA" + "0" * 16,
         "secret: secret: longer-value", "passwordpassword=abcdef", "x " * 30_000 + "secret=ABCdef123",
         "my pwd is x7!Gq#pL2v, ok", "the password is required here", "pin: 2024-01-31", "login pass: P@ssw0rd", "toKen=abcdef",
         "ſecret=abcdef"]


def test_base_spans_of_a_table(spark, docs):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[4])]
    got = secret_digest(secret_spans(docs(rows))).collect()
    want = []
    for i, t in rows:
        base = base_secrets(t or "")
        want.append((i, *(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")),
                     sha(",".join(f"{k}:{s}:{e}" for k, s, e in base))))
    assert sorted(map(str, ((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got))) == sorted(map(str, want))
    assert secret_spans(docs([])).collect() == []


def test_real_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in secret_spans(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind != "guess"] == base_secrets(text[r.doc_id])


def test_guess_spans_are_added_for_hard_values_only():
    def guesses(t):
        return [t[s.start:s.end] for s in scan(t) if s.kind == 3]

    assert guesses(TEXTS[11]) == ["x7!Gq#pL2v"]
    assert all(guesses(TEXTS[k]) == [] for k in (12, 13, 14))
    assert guesses("token = abcdef123456") == []  # has a span of its own already


@pytest.mark.parametrize(("easy", "hard"), [
    ("password", "pxsvwqrd"), ("2024-01-31", "2024-91-37"), ("aaaaaaaaaaaa", "aqmzkwpxnvtj"), ("qwertyuiop", "qmzkwpxnvt"),
    ("abcabcabcabc", "abcqbzmbckax"), ("12345678", "17384926"), ("P@ssw0rd", "X@sqv0rk"), ("Summer2024", "Sqmzkr8261")])
def test_patterns_cost_less(easy, hard):
    assert guess_cost(easy) + 1.5 < guess_cost(hard)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.text(alphabet="abc12pasword@0-! ", max_size=10))
def test_cost_is_the_cheapest_and_monotone(value):
    """Never above brute force, and joining two halves never beats the whole plus a step."""
    assert 0 <= guess_cost(value) <= len(value) * 1.53
    for k in range(1, len(value)):
        assert guess_cost(value) <= guess_cost(value[:k]) + guess_cost(value[k:]) + 0.31


def test_cost_of_a_long_value_is_linear():
    assert guess_cost("a" * 100_000) < 10 < guess_cost("q8Zm#" * 3)


def test_redaction(spark, docs):
    rows = [(1, "é token = \"0123456789abcdef01234567\" x"), (2, "clean"), (3, None), (4, ""), (1, "clean")]
    table = docs(rows).withColumnRenamed("source", "spans")
    got = redact(table)
    assert got.columns == table.columns
    assert sorted(map(str, ((r.doc_id, r.text, r.spans) for r in got.collect()))) == sorted(map(str, [
        (1, 'é token = "[secret]" x', "s"), (2, "clean", "s"), (3, None, "s"), (4, "", "s"), (1, "clean", "s")]))


def test_a_secret_goes_to_its_end(spark, docs):
    """A sign ends the base span, not the secret; both spans stay, and their union is redacted."""
    text = "password: hunter22!Xy#9 and token=AKIA" + "Z" * 18 + "!q8 end"
    spans = [(s.kind, text[s.start:s.end]) for s in scan(text)]
    assert spans == [(0, "password: hunter22"), (3, "hunter22!Xy#9"), (0, "token=AKIA" + "Z" * 18),
                     (1, "AKIA" + "Z" * 18), (3, "AKIA" + "Z" * 18 + "!q8")]
    assert [r.text for r in redact(docs([(1, text)])).collect()] == ["password: [secret] and token=[secret] end"]


@settings(max_examples=40, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.sampled_from(["password", "=", ":", " ", '"', "abcdef", "AKIA", "ABCDEFGH01234567", "0123456789ab", "é", "api_key"]),
                max_size=14).map("".join))
def test_any_text_has_its_base_spans(text):
    assert [(("assign", "access", "hex")[s.kind], s.start, s.end) for s in scan(text) if s.kind < 3] == base_secrets(text)


def test_any_number_of_blanks(docs):
    text = "password      :     hunterXX!q9 and so on"
    assert [r.text for r in redact(docs([(1, text)])).collect()] == ["password      :     [secret] and so on"]


def cheapest(value, words):
    """The cheapest of all cuts of value into spans, each priced by itself."""
    low = value.lower()
    plain = low.translate(credentials._LEET)
    step = math.log10(2)

    def price(i, j):
        part, n = value[i:j], j - i
        costs = [sum(map(credentials._brute, part))]
        for seen, more in ((low[i:j], 0), (plain[i:j], 2 * step)):
            if seen in words.ranks:
                costs.append(math.log10(words.ranks[seen]) + more + credentials._case(part))
        if re.fullmatch("(19|20)[0-9][0-9]", part):
            costs.append(math.log10(119))
        if credentials._DATE.fullmatch(part):
            costs.append(math.log10(119 * 365 * 4))
        for unit in (1, 2, 3, 4):
            if n >= 3 and n > unit and n % unit == 0 and part == part[:unit] * (n // unit):
                costs.append(sum(map(credentials._brute, part[:unit])) + math.log10(n / unit))
        if n >= 3:
            if all(b in credentials._NEAR.get(a, ()) for a, b in zip(low[i:j], low[i + 1:j], strict=False)):
                costs.append(math.log10(47) + (n - 1) * step)
            gaps = {ord(b) - ord(a) for a, b in zip(low[i:j], low[i + 1:j], strict=False)}
            if gaps in ({1}, {-1}):
                costs.append(math.log10(52) + (n - 1) * step / 2)
        return min(costs)

    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(best[i] + (step if i else 0) + price(i, j) for i in range(j)))
    return best[-1]


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.lists(st.sampled_from(["a", "b", "Pass", "p@ss", "word", "elephant", "2024", "-01-31", "31.12.1999", "qwe", "asd", "123", "cba",
                                 "aa", "xyxy", "!", "Z", "7", "é"]), max_size=5).map("".join))
def test_cost_against_every_cut(value):
    words = credentials.Dictionary({"pass": 3, "word": 7, "password": 1, "elephant": 900, "ant": 40, "élé": 5})
    assert guess_cost(value, words) == pytest.approx(cheapest(value, words))


def test_the_cost_alone_decides_after_a_sign(docs):
    """Letters only, short values and words the corpus has or lacks."""
    prose = "the elephant walked over the mountain and the required form was signed "
    rows = [(k, prose) for k in range(4)] + [
        (10, "bearer: kJhGfDsAqWeRtYuIoPzXcV"), (11, "pwd=xkqzvbnmwrtplkjh"), (12, "pin: 48213"), (13, "pwd: elephant7"),
        (14, "passphrase: required"), (15, "the pin is kxqvzjwpl"), (16, "the pin is q7!kz#W0pd"), (17, "pwd=X!q#$"),
        (18, "credentials = mountain-elephant"), (19, None), (20, "")]
    got = {r.doc_id: [t for t in r.spans] for r in secret_spans(docs(rows)).collect()}
    found = {k: [dict(rows)[k][s.start:s.end] for s in v if s.kind == "guess"] for k, v in got.items()}
    assert {k: v for k, v in found.items() if v} == {
        10: ["kJhGfDsAqWeRtYuIoPzXcV"], 11: ["xkqzvbnmwrtplkjh"], 16: ["q7!kz#W0pd"], 17: ["X!q#$"]}


def test_copies_of_a_secret_are_no_common_word(docs):
    rows = [(k, "bearer: kqzvbnmwrtpl and more of it") for k in range(50)] + [(99, "AND more, and More")]
    words = credentials.corpus_dictionary(docs(rows))
    assert words.ranks["and"] == 1 and "more" in words.ranks and "kqzvbnmwrtpl" not in words.ranks
    assert all(s.kind == "guess" for r in secret_spans(docs(rows)).filter("doc_id < 50").collect() for s in r.spans)
    counts = {r.word: r.n for r in credentials.word_counts(docs(rows)).collect()}
    assert counts == {"and": 52, "more": 52}
    rows.append((100, "and"))  # 53 and 52 are of one class, 52 and 26 are not
    assert set(credentials.corpus_dictionary(docs(rows), size=1).ranks) == set(credentials.COMMON_WORDS)
    rows += [(200, "rare " * 26)]
    words = credentials.corpus_dictionary(docs(rows), size=2)
    assert set(words.ranks) == {*credentials.COMMON_WORDS, "and", "more"} and words.ranks["and"] < words.ranks["more"]
    assert set(credentials.corpus_dictionary(docs([])).ranks) == set(credentials.COMMON_WORDS)
