"""SQL for DuckDB, for the queries that have it."""

#: Ranked lexical search: every score of every document for every item, then the best 50.
SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
i AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark
),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
held AS (
  SELECT rid, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT rid, len(terms) AS n, unnest(terms) AS term FROM d)
  GROUP BY rid, term
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, n_docs
),
scores AS (
  SELECT q, item_id, rid,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM (SELECT q, item_id, unnest(terms) AS term FROM i) JOIN held USING (term) JOIN weights USING (term), totals
  GROUP BY q, item_id, rid
),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores JOIN d USING (rid) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

#: Conversation prefix trie: all prefixes of the rebuilt conversations as lists, and all pairs of a node and one above it.
TRIE = r"""
WITH bytes AS (
  SELECT DISTINCT conv_id, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT) AS b
  FROM conversations WHERE conv_id IS NOT NULL
),
shares AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, v: list_reduce(
    list_prepend(xor(c, v), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 9 AS h
  FROM bytes
),
told AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS turns
  FROM told o JOIN shares USING (conv_id) LEFT JOIN told b ON b.conv_id = o.conv_id - o.conv_id % 5
),
paths AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
  FROM paths GROUP BY turns[1:depth], depth
),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
known AS (
  SELECT path, depth, conv_id, n_convs, ends, coalesce(n_children, 0) AS n_children,
    CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(path[depth].text) ELSE 0 END AS saved
  FROM nodes LEFT JOIN kids USING (path)
),
sums AS (
  SELECT path[1:above] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path, n_children, saved, unnest(range(0, depth + 1)) AS above FROM known) GROUP BY 1
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens,
  sha256(k.ends) AS ends_sha256
FROM known k JOIN sums s USING (path) LEFT JOIN known p ON k.depth > 0 AND p.path = k.path[1:k.depth - 1]
"""
