"""DuckDB SQL for the text queries that SQL can express on whole tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"'[^\x20\x09-\x0D]+'"


def _words(fold: bool) -> str:
    text = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')" if fold else "coalesce(text, '')"
    return f"regexp_extract_all({text}, {_WORDS})"


_REACHED = """
    reached(a, b) AS (
        SELECT id, id FROM nodes
        UNION
        SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
    )"""

OP2 = f"""
WITH items AS (
    SELECT DISTINCT item_id, text, {_words(True)} AS w FROM benchmark
), item_shingles AS (
    SELECT DISTINCT item_id, text, least(5, len(w)) AS k, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
    FROM items, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), item_sizes AS (
    SELECT item_id, text, count(*) AS n_item FROM item_shingles GROUP BY ALL
), docs AS (
    SELECT doc_id, {_words(True)} AS w FROM documents
), doc_shingles AS (
    SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS s
    FROM docs, (SELECT DISTINCT k FROM item_shingles) AS ks, unnest(range(1, len(w) - k + 2)) AS t(i)
), shared AS (
    SELECT doc_id, item_id, text, count(*) AS n_shared
    FROM doc_shingles JOIN item_shingles USING (k, s) GROUP BY ALL
)
SELECT doc_id, item_id, n_shared::INTEGER AS n_shared, n_item::INTEGER AS n_item
FROM shared JOIN item_sizes USING (item_id, text) WHERE 10 * n_shared >= 8 * n_item
"""

OP4 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_words(True)} AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS t(i)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes AS p ON a = p.doc_id JOIN sizes AS q ON b = q.doc_id
    WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), nodes AS (
    SELECT doc_id AS id FROM documents
), {_REACHED}
SELECT d.doc_id, coalesce(max(sizes.n), 0)::BIGINT AS n_shingles, min(reached.b)::BIGINT AS component_id
FROM documents AS d LEFT JOIN sizes USING (doc_id) JOIN reached ON d.doc_id = reached.a GROUP BY d.doc_id
"""

OP7 = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors AS x JOIN vectors AS y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95
), nodes AS (
    SELECT vec_id AS id FROM embeddings
), {_REACHED},
degrees AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
), placed AS (
    SELECT a, min(b)::BIGINT AS component_id FROM reached GROUP BY a
)
SELECT e.vec_id, coalesce(degrees.n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings AS e JOIN placed ON e.vec_id = placed.a LEFT JOIN degrees ON e.vec_id = degrees.a
"""

OP8 = f"""
WITH words AS (
    SELECT doc_id, {_words(False)} AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM words, unnest(range(1, len(w) - 11)) AS t(i)
), firsts AS (
    SELECT s, min(doc_id) AS first FROM windows GROUP BY s
), covered AS (
    SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN firsts USING (s), unnest(range(13)) AS t(j) WHERE doc_id > first
), placed AS (
    SELECT doc_id, i AS p, w[i] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(i)
), kept AS (
    SELECT placed.doc_id, count(*) AS n_words, count(covered.p) AS n_removed, string_agg(word, ' ' ORDER BY placed.p) FILTER (covered.p IS NULL) AS text
    FROM placed LEFT JOIN covered ON placed.doc_id = covered.doc_id AND placed.p = covered.p GROUP BY placed.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents AS d LEFT JOIN kept USING (doc_id)
"""

OP12 = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, list_inner_product(a.q, r.q)::BIGINT AS score
    FROM rows AS a JOIN rows AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""

_HEX = "'0123456789ABCDEF'"
OP13 = f"""
WITH RECURSIVE crc_steps(i, v, k) AS (
    SELECT i, i, 0 FROM range(256) AS t(i)
    UNION ALL
    SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS x FROM runs GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x)::BIGINT, 2), lambda i: (16 * (strpos({_HEX}, x[i + 1]) - 1) + strpos({_HEX}, x[i + 2]) - 1)::BIGINT)), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h
    FROM counted, crc_table
), spelt AS (
    SELECT CASE WHEN h % 97 = 0 THEN run[: h % len(run)] || run[h % len(run) + 2 :] ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
    SELECT word, n, p, word[: p - 1] || word[p + 1 :] AS rest FROM words, unnest(range(1, len(word) + 1)) AS t(p)
), pairs AS (
    SELECT a.word, b.word AS near, b.n FROM less AS a JOIN less AS b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM words AS a JOIN less AS b ON a.word = b.rest
    UNION
    SELECT b.word, a.word, a.n FROM words AS a JOIN less AS b ON a.word = b.rest
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(near, (-n, near)) AS form FROM pairs GROUP BY word
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * words.n THEN form END AS form, CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), walk(word, place) AS (
    SELECT word, word FROM formed
    UNION ALL
    SELECT walk.word, formed.form FROM walk JOIN formed ON walk.place = formed.word WHERE formed.form IS NOT NULL
), ends AS (
    SELECT walk.word, walk.place AS root FROM walk JOIN formed ON walk.place = formed.word WHERE formed.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

ORACLE = {"op2_decontaminate": OP2, "op4_ngram_join": OP4, "op7_embeddings": OP7, "op8_substrings": OP8, "op12_hard_negatives": OP12, "op13_spelling_variants": OP13}
