"""DuckDB SQL for the queries of this package that SQL can express.

The others (op2, op5, op7, op9, op10, op13 and the pipeline) are tested in
tests/llm against brute force, held-out accuracy or a round trip.
"""

from __future__ import annotations

from possum.llm.mixing import CLOSINGS

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, "rank", vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank" FROM scored)
WHERE "rank" <= 5
"""

OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
       (sum(length('<|turn|>') + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))
            + CASE WHEN before = role THEN 0
                   ELSE length('<|block|>') + length(replace(replace(role, '&', '&amp;'), '<|', '&lt;|')) + 1
                        + CASE WHEN place = 1 THEN 0 ELSE length('<|end|>') + 1 END END)
        + length('<|end|>'))::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""

OP4 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({LOWER.format('text')}, '{ALNUM}'), []) AS words FROM documents),
b AS (
  SELECT DISTINCT item_id, words, least(len(words), 10) AS size
  FROM (SELECT item_id, regexp_extract_all({LOWER.format('text')}, '{ALNUM}') AS words FROM benchmark) WHERE len(words) > 0),
win AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM b)),
places AS (
  SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM win))),
hit AS (SELECT r, i, size, item_id FROM places JOIN win USING (size, w)),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids
          FROM hit GROUP BY r),
place AS (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM hit),
run AS (SELECT r, p - row_number() OVER (PARTITION BY r ORDER BY p) AS g FROM place),
runs AS (SELECT r, sum(n) AS n_hit, max(n) AS longest FROM (SELECT r, g, count(*) AS n FROM run GROUP BY r, g) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(longest, 0)::BIGINT AS longest_run
FROM d LEFT JOIN items USING (r) LEFT JOIN runs USING (r)
"""


def _op6() -> str:
    head = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACED}')), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(sqrt(size::DOUBLE) * size) AS pull,
         [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source),
ordered AS (
  SELECT *, coalesce(sum(3 * source_size) OVER w, 0) AS fixed, coalesce(sum(weight) OVER w, 0) AS gone,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM s WINDOW w AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min((total - fixed)::DOUBLE / (weights - gone), gone)
         FILTER (3 * source_size >= (total - fixed)::DOUBLE / (weights - gone) * weight) AS level
  FROM ordered),
f AS (
  SELECT source, source_size, pull, least(coalesce(level, 0) * weight, (3 * source_size)::DOUBLE) AS target FROM s, level),
g AS (
  SELECT *, least(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END, 3)::BIGINT AS whole FROM f),
h AS (SELECT *, greatest(target - whole * source_size, 0.0) AS rest FROM g),
p AS (
  SELECT d.*, h.source_size, h.target, h.whole, h.rest, rest / source_size AS share,
         sqrt(size::DOUBLE) * source_size / pull AS r,
         ((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
q AS (
  SELECT *, least(greatest(share * (1 + (1 - share) * (r - 1) / (r + 1)), 1e-12), 1 - 1e-12) AS pr FROM p),
k AS (
  SELECT *, CASE WHEN size > 0 AND rest > 0 THEN (u / (1 - u)) / (pr / (1 - pr)) END AS odds FROM q),
x0 AS (
  SELECT *, odds IS NOT NULL AND sum(CASE WHEN odds IS NOT NULL THEN size ELSE 0 END)
            OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id NULLS FIRST RANGE UNBOUNDED PRECEDING) <= rest AS extra FROM k)"""
    for n in range(CLOSINGS):
        fits = "abs(gap - adds) < gap" if n == CLOSINGS - 1 else "adds <= gap"
        head += f""",
gap{n} AS (SELECT source, max(rest) - sum(CASE WHEN extra THEN size ELSE 0 END) AS gap FROM x{n} WHERE odds IS NOT NULL GROUP BY source),
out{n} AS (SELECT x.source, doc_id, sum(size) AS adds FROM x{n} x WHERE NOT extra AND odds IS NOT NULL GROUP BY x.source, doc_id),
pick{n} AS (
  SELECT source, doc_id, 1 AS has FROM (
    SELECT o.source, doc_id, row_number() OVER (PARTITION BY o.source ORDER BY abs(gap - adds), doc_id NULLS FIRST) AS n
    FROM out{n} o JOIN gap{n} g ON o.source IS NOT DISTINCT FROM g.source WHERE {fits}) WHERE n = 1),
x{n + 1} AS (
  SELECT x.* REPLACE (extra OR (odds IS NOT NULL AND c.has IS NOT NULL) AS extra)
  FROM x{n} x LEFT JOIN pick{n} c ON x.source IS NOT DISTINCT FROM c.source AND x.doc_id IS NOT DISTINCT FROM c.doc_id)"""
    return head + f"""
SELECT doc_id, source, size, source_size, target, whole + extra::BIGINT AS copies, (whole + extra::BIGINT) * size AS taken FROM x{CLOSINGS}
"""


OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format('text')}, '{SPACED}') AS words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM both_ JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (
  SELECT doc_id, doc_id AS y FROM documents WHERE doc_id IS NOT NULL
  UNION SELECT r.doc_id, l.y FROM reach r JOIN link l ON r.y = l.x),
comp AS (SELECT doc_id, min(y) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(doc_id = component_id, true) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

OP11 = f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda a, k:
           CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS tab),
r AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS i, unnest(regexp_extract_all({LOWER.format('text')}, '[a-zÀ-ÿ]+')) AS run FROM documents),
p AS (
  SELECT run, length(run) AS l, count(*) AS c, hex(encode(i || ':' || run)) AS x FROM r WHERE length(run) >= 7 GROUP BY i, run),
h AS (
  SELECT run, l, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::BIGINT)),
                        lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1])), 4294967295) AS h FROM p, tab),
v AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT c, CASE WHEN h % 31 = 0 THEN left(run, h % l) || substr(run, h % l + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
d AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS d FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
shorter AS (SELECT DISTINCT d.word AS long, v.word AS short FROM d JOIN v ON d.d = v.word),
pairs AS (
  SELECT a.word, b.word AS near FROM d a JOIN d b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place
  FROM (SELECT p.word, near, v.n AS near_n FROM pairs p JOIN v ON v.word = p.near)),
f AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM v LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS hop FROM f
  UNION ALL SELECT w.word, f.form, hop + 1 FROM walk w JOIN f ON f.word = w.here WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, hop) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN roots USING (word)
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT r, doc_id, i, line, {LOWER.format(f"trim(line, {_BLANKS})")} AS key
  FROM (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d)),
repeated AS (
  SELECT key, max(doc_id) AS largest FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, coalesce(doc_id < largest, false) AS gone FROM l LEFT JOIN repeated USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""

ORACLES: dict[str, str] = {
    "op1_norm_bucket_topk": OP1,
    "op3_chat_formatting": OP3,
    "op4_suffix_decontamination": OP4,
    "op6_pareto_mixing": _op6(),
    "op8_minhash_neardup": OP8,
    "op11_spelling_variants": OP11,
    "op12_line_dedup": OP12,
}
