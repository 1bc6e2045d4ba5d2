"""DuckDB SQL for the corpus queries that SQL can express."""

# --- 1: every pair of document and item, containment by text ----------------------------

_SHINGLES = """
    SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) + 2 - k),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
    FROM (SELECT {key}, w, {lengths} AS k FROM (
        SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM {table}))
    WHERE k BETWEEN 1 AND len(w)
"""
_ROWS = "(SELECT *, row_number() OVER () AS rid FROM documents)"

DECONTAMINATION = f"""
WITH item AS ({_SHINGLES.format(key="item_id", table="benchmark", lengths="least(5, len(w))")}),
sized AS (SELECT item_id, s, count(*) OVER (PARTITION BY item_id) AS n FROM item),
doc AS ({_SHINGLES.format(key="rid, doc_id", table=_ROWS, lengths="unnest([1, 2, 3, 4, 5])")})
SELECT DISTINCT doc_id, item_id, n_shingles, n_matched FROM (
    SELECT rid, doc_id, item_id, max(n) AS n_shingles, count(*) AS n_matched
    FROM doc JOIN sized USING (s) GROUP BY ALL)
WHERE n_matched >= 0.8 * n_shingles
"""

# --- 10: exact distinct sites and sets of lines --------------------------------------------

_BLANKS = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"

LINE_DEDUP = f"""
WITH numbered AS (SELECT row_number() OVER () AS rid, * FROM documents),
raw AS (
    SELECT rid, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM numbered),
lines AS (SELECT *, trim(line, {_BLANKS}) AS body FROM raw),
sets AS (SELECT rid, list(DISTINCT body ORDER BY body) AS held FROM lines WHERE body <> '' GROUP BY rid),
boilerplate AS (
    SELECT body FROM lines JOIN sets USING (rid) WHERE body <> ''
    GROUP BY body HAVING count(DISTINCT site) >= 10 AND count(DISTINCT held) >= 10),
marked AS (SELECT *, body IN (SELECT body FROM boilerplate) AS gone FROM lines),
rebuilt AS (
    SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
           count(*) FILTER (WHERE gone) AS n_removed
    FROM marked GROUP BY rid)
SELECT n.doc_id, r.text, coalesce(r.n_removed, 0) AS n_removed
FROM numbered n LEFT JOIN rebuilt r USING (rid)
"""

# --- 4: the article element, which these pages have; references of the kinds they hold ---

HTML_EXTRACTION = r"""
WITH pieces AS (
    SELECT page_id, url, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS pos
    FROM (SELECT page_id, url, regexp_split_to_array(
            regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(p|h1)>') AS blocks
          FROM pages)),
decoded AS (
    SELECT page_id, url, pos, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(block, '<[^>]*>', ' ', 'g'),
        '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS block
    FROM pieces),
joined AS (
    SELECT page_id, string_agg(block, chr(10) || chr(10) ORDER BY pos) FILTER (WHERE block <> '') AS text
    FROM decoded GROUP BY page_id)
SELECT p.page_id, p.url, coalesce(j.text, '') AS text, length(coalesce(j.text, '')) AS n_chars
FROM pages p LEFT JOIN joined j USING (page_id)
"""

# --- 7: all pairs, and what is reached from each vector ------------------------------------

EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS (
    SELECT vec_id, e FROM vectors
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS one, b.vec_id AS other FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (
    SELECT vec_id, vec_id AS member FROM vectors
    UNION
    SELECT r.vec_id, l.other FROM reached r JOIN links l ON r.member = l.one),
counted AS (SELECT one AS vec_id, count(*) AS n FROM links GROUP BY one)
SELECT r.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(r.member) AS component_id,
    r.vec_id = min(r.member) AS kept
FROM reached r LEFT JOIN counted c USING (vec_id) GROUP BY r.vec_id
"""

# --- 12: every row's product with every anchor ---------------------------------------------

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (
        PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

# --- 13: every document's score, term by term ----------------------------------------------

_TERMS = r"""
    SELECT row_number() OVER () AS {row}, {key}, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM {table}
"""

LEXICAL_SEARCH = f"""
WITH doc AS ({_TERMS.format(row="rid", key="doc_id", table="documents")}),
item AS ({_TERMS.format(row="iid", key="item_id", table="benchmark")}),
total AS (SELECT count(*) AS docs, sum(len(terms)) AS terms FROM doc WHERE len(terms) > 0),
sized AS (
    SELECT rid, doc_id, CAST(25 + (75 * len(doc.terms) * docs) // total.terms AS BIGINT) AS m
    FROM doc, total WHERE len(doc.terms) > 0),
asked AS (SELECT iid, term, count(*) AS times FROM (SELECT iid, unnest(terms) AS term FROM item) GROUP BY ALL),
held AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM doc)
         WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, total GROUP BY term, docs),
scored AS (
    SELECT iid, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weighed USING (term) JOIN sized USING (rid) GROUP BY ALL),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (iid) WHERE rank <= 10
"""

ORACLES = {
    "op1_benchmark_decontamination": DECONTAMINATION,
    "op4_html_extraction": HTML_EXTRACTION,
    "op7_embedding_near_dedup": EMBEDDING_NEAR_DEDUP,
    "op10_line_dedup": LINE_DEDUP,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_ranked_lexical_search": LEXICAL_SEARCH,
}
