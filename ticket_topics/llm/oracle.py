"""The queries that SQL can express, in DuckDB's dialect."""

OP6 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept,
       h AS text_sha256
FROM t
"""

OP9 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h
  FROM pages
), q AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM p
)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM q
"""

# All pairs of one label, and the smallest id that links reach.
OP11 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.x) = len(b.x)
    AND list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.93
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""

# Near words by the words and the places that one deletion leaves.
OP13 = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w
  FROM documents
), counted AS (SELECT doc_id, w, count(*) AS n, hex(encode(doc_id || ':' || w)) AS x FROM runs GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, length(x) // 2),
      lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),
      lambda d, k: CASE WHEN d % 2 = 1 THEN xor(3988292384, d // 2) ELSE d // 2 END))) AS h
  FROM counted
), slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, n
  FROM hashed
), vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, i, left(word, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM vocabulary)
), near AS (
  SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cut c JOIN vocabulary v ON c.rest = v.word
  UNION SELECT v.word, c.word FROM cut c JOIN vocabulary v ON c.rest = v.word
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-v.n, other)) AS other, max(v.n) AS other_n
  FROM near JOIN vocabulary v ON v.word = near.other GROUP BY near.word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 2 * v.n THEN other END AS form, CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
), path(word, place) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT path.word, form FROM path JOIN forms ON forms.word = path.place WHERE form IS NOT NULL
), roots AS (
  SELECT path.word, path.place AS root FROM path JOIN forms ON forms.word = path.place WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

ORACLE = {
    "op6_exact_dedup": OP6,
    "op9_warc": OP9,
    "op11_multi_index": OP11,
    "op13_spelling_variants": OP13,
}
