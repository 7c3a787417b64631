"""Queries of this subpackage, and SQL texts (DuckDB) for those that SQL can say on whole tables.

The others have no such text: 1, 7, 8 and 12 train models, 3 to 6 and 11 need
crc32, a tokenizer or an image format; tests hold them against brute force instead.
"""

from __future__ import annotations

from placeflow.llm import class_lm, filter_audit, language, media, near_dedup, packing, periodic_runs, pieces, quality_crf, quality_rules, sharding, substring_dedup, toxicity

QUERIES = {
    "op1_byte_gru": language.op1_byte_gru,
    "op2_host_rules": quality_rules.op2_host_rules,
    "op3_jpeg_media": media.op3_jpeg_media,
    "op4_feistel_shards": sharding.op4_feistel_shards,
    "op5_vector_packing": packing.op5_vector_packing,
    "op6_piece_lattice": pieces.op6_piece_lattice,
    "op7_line_crf": quality_crf.op7_line_crf,
    "op8_brown_classes": class_lm.op8_brown_classes,
    "op9_hyperminhash": near_dedup.op9_hyperminhash,
    "op10_debruijn_spans": substring_dedup.op10_debruijn_spans,
    "op11_harmonic_runs": periodic_runs.op11_harmonic_runs,
    "op12_clause_grammar": toxicity.op12_clause_grammar,
    "op13_shapley_audit": filter_audit.op13_shapley_audit,
}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, source, t, {_WORDS.format("t")} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
w AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM l),
v AS (SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS e, lead(a, 4) OVER o AS f FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM v WHERE f IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c, e, f) > 1),
p AS (SELECT doc_id, count(DISTINCT i + k.range) AS n FROM r, range({quality_rules.WINDOW}) k GROUP BY 1),
c AS (SELECT l.doc_id, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
  FROM l LEFT JOIN p ON l.doc_id = p.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines OR word_chars > 20 * n_words AS hard,
  100 * n_symbols > 6 * word_chars OR 100 * n_dup_lines > 18 * n_lines OR word_chars > 12 * n_words AS soft FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR hard) AS k FROM b GROUP BY 1),
t AS (SELECT sum(n)::DOUBLE AS n, sum(k)::DOUBLE / sum(n) AS m, sum(k * (k / n)) / sum(n) AS q, count(*) AS hosts FROM h),
s AS (SELECT n, m, q - m * m - hosts * m * (1 - m) / n AS spread FROM t),
u AS (SELECT m, CASE WHEN spread > 1e-12 AND m > 0 AND m < 1 THEN least(greatest(m * (1 - m) / spread - 1, 1.0), n) ELSE n END AS w FROM s),
g AS (SELECT source, (k + m * w) / (n + w) AS rate FROM h, u)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (hard OR rate > {quality_rules.HOST_REJECT} OR (rate > {quality_rules.HOST_SUSPECT} AND soft)) AS kept, round(rate, 6) AS host_rate
FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source"""

_OP9 = f"""
WITH RECURSIVE l AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS x FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM l WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM j JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * i >= {near_dedup.SIMILARITY} * (p.n + q.n - i)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT l.doc_id, coalesce(n.n, 0) AS n_shingles, least(l.doc_id, coalesce(c.b, l.doc_id)) AS component_id, l.doc_id <= coalesce(c.b, l.doc_id) AS kept
FROM l LEFT JOIN n ON l.doc_id = n.doc_id LEFT JOIN c ON l.doc_id = c.a"""

_OP10 = f"""
WITH l AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
v AS (SELECT doc_id, i, array_to_string(ws[i:i + {substring_dedup.K - 1}], ' ') AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {substring_dedup.K - 2})) AS i FROM l)),
g AS (SELECT doc_id, i FROM v QUALIFY min(doc_id) OVER (PARTITION BY x) < doc_id),
r AS (SELECT DISTINCT doc_id, i + k.range AS i FROM g, range({substring_dedup.K}) k),
w AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM l),
k AS (SELECT w.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY w.i) AS t FROM w ANTI JOIN r ON w.doc_id = r.doc_id AND w.i = r.i GROUP BY 1)
SELECT l.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM l LEFT JOIN k ON l.doc_id = k.doc_id"""

_OP13 = rf"""
WITH RECURSIVE g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS.format("t")} AS ws FROM d),
f AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
  100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t) AS c, length(translate(t, '#$%&*|', '')) < length(t) AS d,
  coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e FROM w),
x AS (SELECT f.part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
  count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN g USING (doc_id) GROUP BY 1, 2),
o(o) AS (SELECT '' UNION ALL SELECT o || l FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l) WHERE NOT contains(o, l)),
s AS (SELECT o AS filter_order, CAST(i.range AS INTEGER) AS step, substr(o, CAST(i.range AS INTEGER), 1) AS f, substr(o, 1, CAST(i.range AS INTEGER) - 1) AS p FROM o, range(1, 6) i WHERE length(o) = 5),
k AS (SELECT part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) AS own, length(translate(fails, p, '')) < length(fails) AS gone FROM x, s),
r AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT own AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (own AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (own AND gone), 0) AS redundant,
  coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails, coalesce(sum(good) FILTER (own AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (own AND NOT gone), 0) AS toxic_lost FROM k GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""

ORACLES: dict[str, str] = {"op2_host_rules": _OP2, "op9_hyperminhash": _OP9, "op10_debruijn_spans": _OP10, "op13_shapley_audit": _OP13}


def queries() -> dict:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
