"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Fixed value: a word of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP4 = rf"""
WITH iw AS (SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), []) AS w FROM documents),
pos AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, pos.n, i, item_id FROM pos JOIN win ON pos.n = win.n AND pos.g = win.g),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP11 = rf"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents WHERE text IS NOT NULL),
corpus AS (SELECT count(*) AS total, CAST(sum(len(w)) AS BIGINT) AS words FROM dw WHERE len(w) > 0),
it AS (SELECT ir, item_id, unnest(list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'))) AS t
       FROM (SELECT item_id, text, row_number() OVER () AS ir FROM benchmark WHERE text IS NOT NULL)),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM dw) SEMI JOIN it USING (t) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY t),
len AS (SELECT doc_id, r, 100 - 90 + ((90 * len(w) * total) // words) AS m FROM dw, corpus WHERE len(w) > 0),
score AS (SELECT ir, item_id, r, CAST(sum(weight.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
          FROM it JOIN tf USING (t) JOIN weight USING (t) JOIN len USING (r) GROUP BY ir, item_id, r),
ranked AS (SELECT ir, item_id, doc_id, score, row_number() OVER (PARTITION BY ir ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
           FROM score JOIN len USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op4_benchmark_decontamination": OP4, "op11_lexical_search": OP11}
