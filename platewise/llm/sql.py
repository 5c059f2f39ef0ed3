"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from platewise.llm import mixing, queries, secrets


def _hash52(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 13))::BIGINT"


def _op1() -> str:
    weight = " ".join(f"WHEN '{k}' THEN {v}" for k, v in queries.MIX_WEIGHTS.items())
    seed = queries.MIX_SEED
    doc = "coalesce(doc_id::VARCHAR, 'null')"
    return f"""
WITH RECURSIVE sizes AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS size FROM documents GROUP BY source),
weighted AS (SELECT *, CASE source {weight} ELSE {queries.MIX_OTHERS} END::DOUBLE AS weight FROM sizes),
rates AS (SELECT source, weight * (sum(size) OVER ())::DOUBLE / (sum(weight) OVER () * size::DOUBLE) AS rate FROM weighted),
drawn AS (SELECT source, rate, greatest(1, ceil(rate / {mixing.RATE_STEP}))::INT AS draws FROM rates),
steps AS (SELECT source, draws, rate / draws AS r, 0 AS k, exp(-rate / draws) AS p, exp(-rate / draws) AS c FROM drawn
  UNION ALL SELECT source, draws, r, k + 1, p * r / (k + 1), c + p * r / (k + 1) FROM steps WHERE k + 1 < {mixing.TERMS}),
bounds AS (SELECT source, draws, list(floor(c * 4503599627370496.0)::BIGINT ORDER BY k) AS steps FROM steps GROUP BY ALL),
draw AS (SELECT d.*, b.steps, unnest(generate_series(1, b.draws)) AS i FROM documents d JOIN bounds b
  ON d.source IS NOT DISTINCT FROM b.source),
counted AS (SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(steps, lambda s: s <= CASE WHEN i = 1
  THEN {_hash52(f"'{seed}'", doc)} ELSE {_hash52(f"'{seed}'", doc, "i::VARCHAR")} END)))::INT AS repeats
  FROM draw GROUP BY doc_id, text, lang, source, n_chars),
copies AS (SELECT *, unnest(generate_series(1, repeats))::INT AS repeat FROM counted WHERE repeats > 0)
SELECT *, {_hash52(f"'order {seed}'", doc, "repeat::VARCHAR")} AS order_key FROM copies"""


def _op9() -> str:
    found = []
    for no, (kind, _, pattern, group, least) in enumerate(secrets.RULES):
        quoted = pattern.replace("'", "''")
        found.append(f"""
SELECT doc_id, '{kind}' AS kind, {no} AS no, upto - size AS start, upto AS stop FROM (
  SELECT doc_id, held, size, sum(gap + size) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM (
    SELECT doc_id, generate_subscripts(m, 1) AS i, unnest(list_transform(m, lambda x: length(x))) AS size,
      unnest(list_transform(g, lambda x: length(x))) AS held,
      unnest(list_transform(string_split_regex(text, '{quoted}')[:len(m)], lambda x: length(x))) AS gap
    FROM (SELECT doc_id, text, regexp_extract_all(text, '{quoted}', 0) AS m, regexp_extract_all(text, '{quoted}', {group}) AS g
      FROM texts))) WHERE held >= {least}""")
    base = len(secrets.BASE_RULES)
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no){}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{r[0]}') AS n_{r[0]}" for r in secrets.BASE_RULES)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(found)})
SELECT doc_id, {counts}, sha256({joined.format(f' FILTER (no < {base})')}) AS base_sha256, {joined.format('')} AS spans
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER w::INT AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10"""

OP10 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
low AS (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, e.vec_id) AS component_id, coalesce(low, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)"""


OP3 = r"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
  list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words),
kinds AS (SELECT min(doc_id) AS id, s FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT id, len(s) AS n, unnest(s) AS g FROM kinds),
common AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS joint FROM grams a JOIN grams b
  ON a.g = b.g AND a.id < b.id AND a.n * 100 >= 90 * b.n AND b.n * 100 >= 90 * a.n GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * joint >= 90 * (na + nb - joint)),
two AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT id, id AS other FROM kinds UNION SELECT r.id, t.b FROM reach r JOIN two t ON r.other = t.a),
low AS (SELECT id, min(other) AS low FROM reach GROUP BY id)
SELECT x.doc_id, len(x.s)::BIGINT AS n_shingles, coalesce(low, x.doc_id) AS component_id
FROM sets x LEFT JOIN kinds k ON list_sort(x.s) = k.s LEFT JOIN low ON low.id = k.id"""


OP7 = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM words WHERE len(w) >= 13),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM windows),
judged AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM keyed) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM judged),
gone_lists AS (SELECT doc_id, list(i) AS l FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, len(w)::BIGINT AS n, coalesce(len(l), 0)::BIGINT AS r, list_filter(w, lambda x, i: l IS NULL OR NOT list_contains(l, i)) AS k
  FROM words LEFT JOIN gone_lists USING (doc_id))
SELECT doc_id, n AS n_words, r AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""


OP11 = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
f AS (SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
  100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
  count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN known USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, k, 1 << (ascii(o[k]) - 65) AS bit,
  list_sum(list_transform(o[:k - 1].split(''), lambda y: CASE WHEN y = '' THEN 0 ELSE 1 << (ascii(y) - 65) END)) AS earlier
  FROM orders, range(1, 6) r(k)),
found AS (SELECT part, o AS filter_order, k::INT AS step, bit,
  sum(n) FILTER (mask & (earlier::INT | bit) = 0) AS kept, sum(n) FILTER (mask & bit > 0 AND mask & earlier::INT = 0) AS removed,
  sum(n) FILTER (mask & bit > 0 AND mask & earlier::INT > 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
  sum(good) FILTER (mask & bit > 0 AND mask & earlier::INT = 0) AS good_lost,
  sum(toxic) FILTER (mask & bit > 0 AND mask & earlier::INT = 0) AS toxic_lost FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM found"""


def oracle_queries() -> dict[str, str]:
    return {"op1_mix_sources": _op1(), "op3_jaccard_join": OP3, "op4_top_k": OP4, "op7_repeats": OP7, "op9_secret_scan": _op9(), "op10_near_vectors": OP10,
            "op11_filter_audit": OP11}
