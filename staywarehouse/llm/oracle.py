"""DuckDB SQL that the rows of registered queries must equal, written by the contracts."""

from __future__ import annotations

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, key: str, name: str) -> str:
    """Words by place (from 1) of lower-cased texts; A-Z only."""
    return f"""{name}_lists AS (
        SELECT {key}, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS ws
        FROM {table})"""


_DECONTAMINATION = f"""
WITH {_words('documents', 'doc_id', 'doc')}, {_words('benchmark', 'item_id', 'item')},
sizes AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM item_lists WHERE len(ws) > 0),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM sizes, LATERAL unnest(range(1, len(ws) - n + 2)) AS u(i)),
lengths AS (SELECT DISTINCT n FROM windows),
spots AS (
    SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM doc_lists, lengths, LATERAL unnest(range(1, len(ws) - n + 2)) AS u(i)),
found AS (SELECT doc_id, i, n, item_id FROM spots JOIN windows USING (n, w)),
hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, n FROM found), LATERAL unnest(range(i, i + n)) AS u(p)
    GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items,
        string_agg(item, ',' ORDER BY item COLLATE "C") AS listed
    FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, cast(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc_lists LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_JACCARD = f"""
WITH RECURSIVE {_words('documents', 'doc_id', 'doc')},
grams AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
    FROM doc_lists, LATERAL unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i)
    WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT common.a, common.b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 10 * c >= 8 * (x.n + y.n - c)),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, min(other) AS class_id,
    (SELECT count(*) FROM links WHERE links.a = reach.doc_id) AS n_links
FROM reach GROUP BY doc_id
"""

_HARD_NEGATIVES = """
WITH parts AS (
    SELECT DISTINCT vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND coalesce(list_bool_and(list_transform(embedding,
            lambda c: c IS NOT NULL AND isfinite(CAST(c AS DOUBLE)))), true)),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM parts a JOIN parts b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
    p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id
        ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other_id
    ORDER BY n.score DESC, n.other_id) <= 3
"""

STATEMENTS = {"op3_decontamination": _DECONTAMINATION, "op5_jaccard_join": _JACCARD,
              "op12_hard_negatives": _HARD_NEGATIVES}
