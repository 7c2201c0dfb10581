"""The text queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

import string

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', "
    rf"'{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+')"
)

#: Earliest deadline first, slot by slot. A cycle has the blocks ``b`` of each source, counted from
#: ``base``; when it is full, the next one has what each source still has, up to its share.
_MIX = """
WITH RECURSIVE
ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR)) - 1 AS r FROM documents),
src AS (SELECT source AS s, count(*) AS n, (count(*) + 63) // 64 AS blocks FROM documents GROUP BY 1),
shares AS (SELECT s, blocks, greatest(1, round(256 * sqrt(n) / sum(sqrt(n)) OVER ())::BIGINT) AS share FROM src),
m AS (SELECT list(s ORDER BY s) AS ss, list(blocks ORDER BY s) AS bl, list(share ORDER BY s) AS sh,
      sum(blocks)::BIGINT AS total, range(1, count(*)::BIGINT + 1) AS ids FROM shares),
steps(t, start, size, b, base, done, pick, release, deadline, block) AS (
  SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, list_transform(ids, lambda i: 0::BIGINT), list_transform(ids, lambda i: 0::BIGINT),
         list_transform(ids, lambda i: 0::BIGINT), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM m
  UNION ALL
  SELECT t + 1, start, size, b, base, list_transform(ids, lambda i: done[i] + (i = pick)::BIGINT), pick,
         start + (done[pick] - base[pick]) * size // b[pick],
         start + ((done[pick] - base[pick] + 1) * size + b[pick] - 1) // b[pick], done[pick]
  FROM (
    SELECT *, list_sort(list_transform(
        list_filter(ids, lambda i: done[i] - base[i] < b[i] AND (done[i] - base[i]) * size // b[i] <= t - start),
        lambda i: {'d': ((done[i] - base[i] + 1) * size + b[i] - 1) // b[i], 'i': i}))[1].i AS pick
    FROM (
      SELECT t, done, ids, CASE WHEN t = start + size THEN t ELSE start END AS start,
        CASE WHEN t = start + size THEN list_sum(list_transform(ids, lambda i: least(sh[i], bl[i] - done[i])))::BIGINT ELSE size END AS size,
        CASE WHEN t = start + size THEN list_transform(ids, lambda i: least(sh[i], bl[i] - done[i])::BIGINT) ELSE b END AS b,
        CASE WHEN t = start + size THEN done ELSE base END AS base
      FROM steps, m WHERE t < total)))
SELECT doc_id, source, block, release, deadline, (t - 1)::BIGINT AS slot, r % 64 AS place
FROM steps, m, ranked WHERE pick > 0 AND ranked.source = ss[pick] AND r // 64 = block
"""

_SCORES = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, i, ws[i] AS c, CASE WHEN i > 1 THEN ws[i - 1] END AS b, CASE WHEN i > 2 THEN ws[i - 2] END AS a
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
u AS (SELECT c, count(*) AS k FROM p GROUP BY 1), uo AS (SELECT doc_id, c, count(*) AS k FROM p GROUP BY ALL),
d AS (SELECT b, c, count(*) AS k FROM p WHERE i > 1 GROUP BY ALL),
dd AS (SELECT doc_id, b, c, count(*) AS k FROM p WHERE i > 1 GROUP BY ALL),
t AS (SELECT a, b, c, count(*) AS k FROM p WHERE i > 2 GROUP BY ALL),
tt AS (SELECT doc_id, a, b, c, count(*) AS k FROM p WHERE i > 2 GROUP BY ALL),
q AS (
  SELECT p.doc_id, coalesce(t.k - tt.k, 0) AS c3, coalesce(d.k - dd.k, 0) AS c2, u.k - uo.k AS c1,
         coalesce(e.k - ee.k, 0) AS before2, coalesce(v.k - vo.k, 0) AS before1
  FROM p JOIN u USING (c) JOIN uo ON uo.doc_id = p.doc_id AND uo.c = p.c
  LEFT JOIN d ON d.b = p.b AND d.c = p.c LEFT JOIN dd ON dd.doc_id = p.doc_id AND dd.b = p.b AND dd.c = p.c
  LEFT JOIN t ON t.a = p.a AND t.b = p.b AND t.c = p.c
  LEFT JOIN tt ON tt.doc_id = p.doc_id AND tt.a = p.a AND tt.b = p.b AND tt.c = p.c
  LEFT JOIN d e ON e.b = p.a AND e.c = p.b LEFT JOIN dd ee ON ee.doc_id = p.doc_id AND ee.b = p.a AND ee.c = p.b
  LEFT JOIN u v ON v.c = p.b LEFT JOIN uo vo ON vo.doc_id = p.doc_id AND vo.c = p.b),
n AS (SELECT doc_id, len(ws) AS n_words, greatest(sum(len(ws)) OVER () - len(ws), 1) AS others FROM w),
s AS (
  SELECT n.doc_id, any_value(n_words) AS n_words,
    sum(CASE WHEN c3 > 0 THEN ln(c3 / before2) WHEN c2 > 0 THEN ln(0.4 * c2 / before1)
        WHEN c1 > 0 THEN ln(0.16 * c1 / others) WHEN c1 = 0 THEN ln(0.064 / others) END) AS x,
    count(*) FILTER (c3 > 0) AS n_trigram, count(*) FILTER (c3 = 0 AND c2 > 0) AS n_bigram,
    count(*) FILTER (c3 = 0 AND c2 = 0 AND c1 > 0) AS n_unigram, count(*) FILTER (c3 = 0 AND c2 = 0 AND c1 = 0) AS n_unseen
  FROM n LEFT JOIN q USING (doc_id) GROUP BY 1)
SELECT doc_id, n_words::BIGINT AS n_words, round(coalesce(x, 0), 4) AS log_score,
       round(CASE WHEN n_words > 0 THEN x / n_words END, 4) AS mean_log_score,
       n_trigram, n_bigram, n_unigram, n_unseen
FROM s
"""

_COMPONENTS = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWER} AS ws FROM documents),
grams AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 5
    THEN hash(concat_ws(' ', ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4])) ELSE hash(array_to_string(ws, ' ')) END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) >= 5 THEN len(ws) - 3 WHEN len(ws) > 0 THEN 2 ELSE 1 END)) AS i FROM w)),
flat AS (SELECT doc_id, g, count(*) OVER (PARTITION BY doc_id) AS n FROM grams),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM flat x JOIN flat y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN (SELECT DISTINCT doc_id, n FROM flat) USING (doc_id) GROUP BY doc_id
"""


def _codes(rounds: int = 6) -> str:
    """Product codes with every part compared with every entry, round by round."""
    near = lambda r: f"""n{r} AS MATERIALIZED (SELECT rid, p, arg_min(e, d * 16 + e) AS e, min(d) AS d FROM (
      SELECT rid, p, e, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
      FROM parts JOIN b{r} USING (p)) GROUP BY ALL)"""  # noqa: E731
    steps = []
    for r in range(rounds):
        steps.append(near(r))
        steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (
      SELECT p, e, list((s - ((s % k) + k) % k) // k ORDER BY i) AS c FROM (
        SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS k
        FROM n{r} JOIN parts USING (rid, p), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY ALL)
      GROUP BY ALL) m USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS x FROM kept, (SELECT unnest(range(8)) AS p)),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM parts WHERE rid <= 16),
{", ".join([*steps, near(rounds)])},
coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n{rounds} GROUP BY 1),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS books FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, books AS codebooks_sha256
FROM kept JOIN coded USING (rid), books
"""


def _manifest(levels: int = 10, top: int = 6) -> str:
    """Hash trees of up to 8 ** levels leaves a lang and 8 ** top langs, level by level."""
    row = lambda text: "sha256(" + " || ".join(
        f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    ) + ")"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = """list_reduce(list_prepend(4294967295, list_transform(range(1, len(doc_id::VARCHAR) + 1),
        lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""
    tree = lambda t, n: f"""{t}{n}r AS MATERIALIZED (
  SELECT k, i // 8 AS g, list(h ORDER BY i) AS hs, any_value(c) > 1 AS more FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM {t}{n})
  GROUP BY k, i // 8),
{t}{n + 1} AS MATERIALIZED (SELECT k, g AS i, CASE WHEN more THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {t}{n}r)"""  # noqa: E731
    walk = lambda w, t, n: f"""{w}{n + 1} AS (SELECT w.* REPLACE (w.i // 8 AS i,
    CASE WHEN more THEN proof || array_to_string(hs[1:w.i % 8], '') || array_to_string(hs[w.i % 8 + 2:], '') ELSE proof END AS proof,
    CASE WHEN more THEN sha256(array_to_string(hs[1:w.i % 8], '') || v || array_to_string(hs[w.i % 8 + 2:], '')) ELSE v END AS v)
  FROM {w}{n} w JOIN {t}{n}r r ON r.k = w.k AND r.g = w.i // 8)"""  # noqa: E731
    steps = [
        *[tree("t", n) for n in range(levels)],
        f"u0 AS MATERIALIZED (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, k AS name, h FROM t{levels})",
        *[tree("u", n) for n in range(top)],
        *[walk("w", "t", n) for n in range(levels)],
        f"z0 AS (SELECT w.doc_id, w.leaf, w.proof, w.v, '' AS k, u0.i, u0.h AS subroot FROM w{levels} w JOIN u0 ON u0.name = w.k)",
        *[walk("z", "u", n) for n in range(top)],
    ]
    return f"""
WITH leaf AS MATERIALIZED (
  SELECT coalesce('+' || lang, '') AS k, doc_id, {row('text')} AS h,
         CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN {row(lowered)} ELSE {row('text')} END AS v
  FROM documents),
w0 AS MATERIALIZED (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i, doc_id, h AS leaf, '' AS proof, v FROM leaf),
t0 AS (SELECT k, i, leaf AS h FROM w0),
{(',' + chr(10)).join(steps)}
SELECT doc_id, leaf, subroot, u{top}.h AS root, sha256(proof) AS proof_sha256, v AS folded_root, v = u{top}.h AS verified
FROM z{top}, u{top}
"""


ORACLE = {
    "op1_pfair_mix": _MIX,
    "op4_backoff_scores": _SCORES,
    "op7_jaccard_components": _COMPONENTS,
    "op12_merkle_manifest": _manifest(),
    "op13_ball_codes": _codes(),
}
