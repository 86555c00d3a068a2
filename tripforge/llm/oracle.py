"""DuckDB SQL for the queries that SQL can express.

The others are held against brute force in ``tests/llm``: secret scan (learnt
automata), SimHash (XXH64), decontamination (aligned overlaps), license scan
(stretches), token files (tokenizer), page text (trees), toxicity (held-out
accuracy), whitening (eigenvectors) and the pipeline."""

from __future__ import annotations

from tripforge.llm import quality

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SUBSTRINGS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
     s AS (SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
     win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM s),
     firsts AS (SELECT t, min(doc_id) AS m FROM win GROUP BY t),
     gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (t) WHERE m < doc_id),
     words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
     kept AS (SELECT words.r, count(*) AS n, string_agg(x, ' ' ORDER BY words.p) AS t
              FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p WHERE gone.p IS NULL GROUP BY words.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""

_WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
     q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS m FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN m IS DISTINCT FROM page_id AND m IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m IS DISTINCT FROM page_id THEN m END AS refers_to
FROM q"""

_MIX = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('17:' || doc_id) AS o FROM documents),
     t AS (SELECT source, sum(size) AS s FROM d GROUP BY source),
     w AS (SELECT *, CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM t),
     c AS (SELECT *, row_number() OVER (ORDER BY 3.0 * s / w, source) AS k FROM w),
     levels AS (SELECT a.k, (SELECT CAST(sum(s) AS DOUBLE) FROM t)
                     - coalesce(sum(CAST(3 * b.s AS DOUBLE)) FILTER (b.k < a.k), 0) AS rest,
                     sum(b.w) FILTER (b.k >= a.k) AS open, any_value(a.s) AS s, any_value(a.w) AS w
                FROM c a, c b GROUP BY a.k),
     lev AS (SELECT rest / open AS l FROM levels WHERE rest / open * w <= 3.0 * s ORDER BY k LIMIT 1),
     target AS (SELECT source, s, least(CAST(3 * s AS DOUBLE), w * coalesce((SELECT l FROM lev), 1e300)) AS target FROM c),
     plan AS (SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / CAST(s AS DOUBLE)) AS BIGINT) ELSE 0 END AS whole FROM target),
     q AS (SELECT d.*, p.s, p.target, p.whole, CAST(round(p.target) AS BIGINT) - p.whole * p.s AS more,
                  sum(size) OVER (PARTITION BY d.source ORDER BY substr(o, 6, 3), o, doc_id, size
                                  ROWS UNBOUNDED PRECEDING) - size AS before
           FROM d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target,
       CAST(whole * size + greatest(0, least(size, more - before)) AS BIGINT) AS taken
FROM q"""


def _quality() -> str:
    r = quality.QualityRules()
    text = lambda p: "'" + p.replace("'", "''") + "'"
    n = r"len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))"
    bad = (f"regexp_matches(l, {text(quality.SEPARATORS)})"
           f" OR (length(l) <= {r.menu_chars} AND regexp_matches(l, {text(quality.MENU)}))"
           f" OR (length(l) <= {r.boilerplate_chars} AND regexp_matches(l, {text(quality.BOILERPLATE)}))"
           f" OR length(regexp_replace(l, '[^#*$%&|<>]+', '', 'g')) > length(l) * CAST({r.max_symbol_share} AS DOUBLE)"
           f" OR ({n} < {r.min_line_words} AND NOT regexp_matches(l, {text(quality.CLOSED)}))")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
     s AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
     win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x FROM s),
     again AS (SELECT r, x FROM win GROUP BY r, x HAVING count(*) > 1),
     rep AS (SELECT r, count(DISTINCT p) AS n FROM (
             SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win JOIN again USING (r, x)) GROUP BY r),
     ln AS (SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
     lines AS (SELECT r, count(*) - count(DISTINCT l) AS dup, sum(CASE WHEN {bad} THEN {n} ELSE 0 END) AS lost FROM ln GROUP BY r),
     f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
                  coalesce(lost, 0) AS lost
           FROM d LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
     g AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_share} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= n_words * CAST({r.max_lost_share} AS DOUBLE) AS kept
FROM g"""


_NEGATIVES = """
WITH sound AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS q
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
     v AS (SELECT r, vec_id, q, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM sound),
     s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
                  CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r),
     p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5),
     n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                  row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id, s.b) AS rank
           FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {"op2_substring_dedup": _SUBSTRINGS, "op3_warc": _WARC, "op6_mix": _MIX, "op10_quality": _quality(),
            "op13_hard_negatives": _NEGATIVES}
