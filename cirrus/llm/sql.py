"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from cirrus.llm.licenses import BASE, NOTICES, Template

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), q AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 20 = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
  FROM q JOIN v ON len(q.v) = len(v.v) AND q.vec_id <> v.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

SHARDING = """
WITH r AS (
  SELECT row_number() OVER () AS row, doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    list_reduce(list_transform(range(1, 16), lambda i: CAST(instr('0123456789abcdef',
      substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), i, 1)) - 1 AS BIGINT)),
      lambda a, b: a * 16 + b) AS h
  FROM documents
), l AS (SELECT r.*, d, h >> (60 - d) AS p FROM r, (SELECT CAST(unnest(range(0, 41)) AS INTEGER) AS d)),
s AS (SELECT d, p, sum(n_bytes) AS n, min(h) AS low, max(h) AS high FROM l GROUP BY d, p),
x AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n_bytes) AS n_bytes, any_value(h) AS h, min(d) AS depth
  FROM l JOIN s USING (d, p) WHERE n <= 1048576 OR low = high GROUP BY row
)
SELECT doc_id, n_bytes, depth, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard, CAST(0 AS BIGINT) AS page FROM x
"""

MIXING = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), h AS (
  SELECT *, list_reduce(list_transform(range(1, 13), lambda i: CAST(instr('0123456789abcdef',
    substr(md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR))), i, 1)) - 1 AS BIGINT)),
    lambda a, b: a * 16 + b) / 281474976710656.0::DOUBLE AS spread FROM d
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM h GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS most,
    CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), o AS (
  SELECT *, most / weight AS stop,
    coalesce(sum(most) OVER b, 0) AS stopped, coalesce(sum(weight) OVER b, 0) AS weights FROM w
  WINDOW b AS (ORDER BY most / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), e AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * (SELECT sum(source_size) FROM s) - CAST(stopped AS DOUBLE))
    / (CAST((SELECT sum(weight) FROM w) AS DOUBLE) - CAST(weights AS DOUBLE)) AS rate FROM o
), m AS (SELECT coalesce((SELECT rate FROM e WHERE stop >= rate ORDER BY stop, weight, rate LIMIT 1), (SELECT max(stop) FROM e)) AS rate),
t AS (SELECT source, source_size, least((SELECT rate FROM m) * weight, CAST(most AS DOUBLE)) AS target FROM w),
q AS (
  SELECT h.row, h.doc_id, h.source, h.size, h.spread, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    coalesce(CAST(sum(h.size) OVER (PARTITION BY h.source ORDER BY h.spread, h.doc_id NULLS LAST, h.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
  FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT q.*, copy, before + copy * source_size AS begin,
    greatest(0, least(size, budget - before - copy * source_size)) AS got FROM q, (SELECT unnest([0, 1]) AS copy)
), f AS (
  SELECT *, coalesce(begin / nullif(target, 0), 0) AS start, coalesce((begin + size) / nullif(target, 0), 0) AS finish FROM c
), k AS (SELECT *, CASE WHEN start >= 1 THEN 2 + spread ELSE least(finish, 1.999) END AS key FROM f),
g AS (
  SELECT *, coalesce(CAST(sum(got) OVER (ORDER BY key, finish, spread, doc_id NULLS LAST, copy, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS mix_start,
    CAST(sum(got) OVER (PARTITION BY row) AS BIGINT) AS taken FROM k
)
SELECT doc_id, size, source_size, target, taken, mix_start FROM g WHERE copy = 0
"""


def licence_sql(templates: tuple[Template, ...] = (*BASE, *NOTICES)) -> str:
    """Words by a regular expression, every template's phrase by comparing the
    words that follow each other at every place."""
    at = lambda t, j: f"w[CAST(i + {j - t.first} AS BIGINT)] = '{t.words[j]}'"  # noqa: E731
    places, shares, labels, base = [], [], [], []
    for n, t in enumerate(templates):
        key = " AND ".join(at(t, j) for j in t.key)
        places.append(f"list_filter(CASE WHEN list_contains(w, '{t.words[t.first]}') THEN range(1, len(w) + 1) ELSE [] END, lambda i: coalesce({key}, false)) AS t{n}")
        rest = [f"CASE WHEN i + {j - t.first} >= 1 AND {at(t, j)} THEN 1 ELSE 0 END" for j in range(len(t.words)) if j not in t.key]
        shares.append(f"coalesce(list_max(list_transform(t{n}, lambda i: ({' + '.join([str(t.n), *rest])}) / CAST({len(t.words)} AS DOUBLE))), 0.0)")
        label = f"CASE WHEN len(t{n}) > 0 THEN '{t.label}' END"
        labels.append(label)
        base += [(n, label)] if t.base else []
    joined = lambda ls: f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{', '.join(ls)}], lambda x: x IS NOT NULL))), ','), '')"  # noqa: E731
    starts = " || ".join(f"t{n}" for n, _ in base)
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (SELECT doc_id, w, {", ".join(places)} FROM d),
x AS (SELECT *, {starts} AS starts FROM p)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(starts) AS BIGINT) AS n_base,
  CAST(list_min(starts) - 1 AS BIGINT) AS first_word, CAST(list_max(starts) - 1 AS BIGINT) AS last_word,
  {joined([label for _, label in base])} AS base_labels, {joined(labels)} AS labels, greatest({", ".join(shares)}) AS score
FROM x
"""


def clusters_sql(k: int = 40, rounds: int = 5, dims: int = 64, by: int = 256, seed: str = "2") -> str:
    """One table of centroids and one of nearest centroids a round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT row, c AS cluster, d AS distance FROM (
    SELECT x.row, c.c, CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM x, c{i} c)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT cluster, i, CAST(sum(v[i]) AS HUGEINT) AS s, count(*) AS n FROM a{i} JOIN x USING (row), (SELECT unnest(range(1, {dims + 1})) AS i) GROUP BY cluster, i)
    GROUP BY cluster) m ON m.cluster = c.c)""")
    return f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({by} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM x QUALIFY c < {k}),
{", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c.v, lambda v: CAST(v AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN x USING (row) JOIN c{rounds} c ON c.c = cluster
"""


def phrases_sql(least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000) -> str:
    """Every phrase spelled out and counted."""
    return rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')), '[^ 	]+') AS w FROM documents
), g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT unnest(range(1, {longest + 1})) AS m))
), f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= {least}),
inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, a FROM (
    SELECT lang, w, a, k, unnest(range(1, m - k + 2)) AS i FROM c, (SELECT unnest(range(2, {longest})) AS k) WHERE k < m)
), kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= {percent} * c.a)),
cuts AS (
  SELECT kept.lang, kept.phrase, a, k, l.f AS l, r.f AS r, n, (CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) kept JOIN n ON n.lang = kept.lang
  JOIN f l ON l.lang = kept.lang AND l.m = k AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = kept.lang AND r.m = len(w) - k AND r.phrase = array_to_string(w[k + 1:], ' ')
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= {top}
"""


ORACLE = {
    "op1_top_k": TOP_K,
    "op2_sharding": SHARDING,
    "op6_license_scan": licence_sql(),
    "op8_mixing": MIXING,
    "op12_clusters": clusters_sql(),
    "op13_phrases": phrases_sql(),
}
