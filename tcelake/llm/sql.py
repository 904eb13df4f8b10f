"""DuckDB SQL for the operators whose results SQL can express, written from their definitions, not from their methods."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _list(text: str, separators: str) -> str:
    """The non-empty parts of a text between runs of the separators."""
    return f"list_filter(regexp_split_to_array({text}, '{separators}'), lambda w: w <> '')"


#: Runs of letters, digits and everything beyond ASCII.
_WORDS = _list(_LOWER, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Runs between ASCII white space.
_TOKENS = _list(_LOWER, r"[\x20\x09-\x0D]+")
_PIECES = rf"unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\n-\r]'))"
_PHRASE = "array_to_string(w[i:i + {0} - 1], ' ')"

#: Smallest id reachable over the links ``a, b``.
_REACH = """reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
    SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
{_REACH},
direct AS (SELECT a, count(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id))::BIGINT AS component_id,
    vec_id <= coalesce(low, vec_id) AS kept
FROM v LEFT JOIN direct d ON d.a = vec_id LEFT JOIN lowest l ON l.a = vec_id
"""

NEAR_COPIES = f"""
WITH RECURSIVE t AS (
    SELECT doc_id, {_TOKENS} AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS e FROM t),
-- Of two sets that alike, one of the rarest 20 % (and one) of either's shingles is in both.
rare AS (
    SELECT doc_id, sh, row_number() OVER (PARTITION BY doc_id ORDER BY df, sh) AS nth, n
    FROM (SELECT doc_id, sh, n, count(*) OVER (PARTITION BY sh) AS df FROM (SELECT doc_id, unnest(e) AS sh, len(e) AS n FROM s))
    QUALIFY nth <= n - (80 * n + 99) // 100 + 1),
met AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM rare x JOIN rare y USING (sh) WHERE x.doc_id <> y.doc_id),
links AS (
    SELECT a, b FROM met JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
    WHERE 180 * len(list_intersect(x.e, y.e)) >= 80 * (len(x.e) + len(y.e))),
{_REACH},
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, len(e)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id))::BIGINT AS component_id, doc_id <= coalesce(low, doc_id) AS kept
FROM s LEFT JOIN lowest ON a = doc_id
"""

CONTAMINATION = f"""
WITH items AS (
    SELECT item_id, {_WORDS} AS w FROM benchmark),
spans AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS span
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM spans),
windows AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS span FROM (
        SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN lengths ON n <= len(w))),
hits AS (SELECT r, i, n, item_id FROM windows JOIN spans USING (n, span)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
    SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed
    FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

COLLOCATIONS = f"""
WITH pieces AS (
    SELECT lang, {_list("piece", r"[\x20\x09]+")} AS w FROM (SELECT coalesce(lang, 'und') AS lang, {_PIECES} AS piece FROM documents)),
phrases AS (
    SELECT lang, k, {_PHRASE.format("k")} AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS ks(k) WHERE len(w) >= k)
    GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND f >= 10),
around AS (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM candidates WHERE k = 3),
whole AS (
    SELECT c.* FROM candidates c LEFT JOIN (SELECT lang, phrase, max(f) AS most FROM around GROUP BY ALL) m ON m.lang = c.lang AND m.phrase = c.phrase
    WHERE most IS NULL OR 100 * most < 50 * f),
cuts AS (
    SELECT lang, phrase, f, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:k], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS i FROM whole)),
scored AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, i,
        (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = head JOIN phrases y ON y.lang = c.lang AND y.phrase = tail),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ordered JOIN totals USING (lang) WHERE rank <= 2000
"""

FILTER_AUDIT = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_list("coalesce(text, '')", r"[\x20\x09-\x0D]+")} AS w FROM documents),
l AS (SELECT doc_id, max(quality) AS good, max(toxic) AS bad FROM labels GROUP BY doc_id),
fails AS (
    SELECT part, coalesce(good = 1, false) AS good, coalesce(bad = 1, false) AS bad, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
        WHEN 'A' THEN len(w) < 100
        WHEN 'B' THEN 100 * len(list_distinct(w)) < 80 * len(w)
        WHEN 'C' THEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)
        WHEN 'D' THEN regexp_matches(t, '[#$%&*|]')
        ELSE coalesce(earlier, false) END) AS f
    FROM (SELECT *, min(doc_id) OVER (PARTITION BY t) < doc_id AS earlier FROM d) LEFT JOIN l USING (doc_id)),
kinds AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM fails GROUP BY ALL),
orders AS (
    SELECT [c] AS o FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c)
    UNION ALL SELECT list_append(o, c) FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT list_contains(o, c)),
steps AS (SELECT array_to_string(o, '') AS filter_order, unnest(range(1, 6)) AS step, o FROM orders WHERE len(o) = 5),
counted AS (
    SELECT part, filter_order, step, o[step] AS own,
        coalesce(sum(n) FILTER (NOT list_has_any(f, o[1:step])), 0) AS kept,
        coalesce(sum(n) FILTER (list_contains(f, o[step]) AND NOT list_has_any(f, o[1:step - 1])), 0) AS removed,
        coalesce(sum(n) FILTER (list_contains(f, o[step]) AND list_has_any(f, o[1:step - 1])), 0) AS redundant,
        coalesce(sum(n) FILTER (f = [o[step]]), 0) AS unique_fails,
        coalesce(sum(good) FILTER (list_contains(f, o[step]) AND NOT list_has_any(f, o[1:step - 1])), 0) AS good_lost,
        coalesce(sum(bad) FILTER (list_contains(f, o[step]) AND NOT list_has_any(f, o[1:step - 1])), 0) AS toxic_lost
    FROM kinds, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
