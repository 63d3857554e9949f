"""Registered queries: substrings, conversations, hard negatives."""

from pyspark.sql import functions as F

from chatterscope.llm.common import table
from chatterscope.llm.conversations import damaged, repaired, summaries
from chatterscope.llm.debruijn import substring_dedup
from chatterscope.llm.hard_negatives import hard_negatives
from chatterscope.llm.registry import query

OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(CAST(x AS DOUBLE)), false))) = len(embedding)),
a AS (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
  FROM a JOIN v ON a.vec_id IS DISTINCT FROM v.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark, sf):
    label = F.col("label").cast("long")
    vectors = table(spark, sf, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    )
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


# Inserts are left out: with these costs, deleting the row next to an inserted one is always cheaper. So all cheapest edits of a
# conversation have one edit a row, and the least of them can be found state by state.
OP12_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
ks AS (SELECT DISTINCT k FROM c),
crc AS (
  SELECT k, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END))) % 20 AS kind
  FROM ks),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM c JOIN crc USING (k) CROSS JOIN (SELECT unnest([1, 2]) AS copy)
  WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
ids AS (SELECT conv_id, row_number() OVER () AS id FROM (SELECT DISTINCT conv_id FROM conversations)),
n AS (
  SELECT id, turn, role, text, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM d JOIN ids ON d.conv_id IS NOT DISTINCT FROM ids.conv_id),
f AS (
  SELECT id, turn, role, text, i, initial,
    CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY id, role, text ORDER BY i) > 1 THEN 2
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY id ORDER BY i) AS before
  FROM n),
moves AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS t(state, initial, next)),
edits AS (
  SELECT id, i, m.state, m.next, 'K' AS edit, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS price
  FROM f JOIN moves m USING (initial) WHERE fault IN (0, 3)
  UNION ALL
  SELECT id, i, m.state, m.next, 'R', CASE WHEN fault = 3 THEN 6 ELSE 1 END
  FROM f CROSS JOIN moves m WHERE fault IN (0, 3) AND m.initial <> 's'
  UNION ALL
  SELECT id, i, s.state, s.state, 'D', 2 FROM f CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS state) s),
walk AS (
  SELECT id, CAST(0 AS BIGINT) AS i, 0 AS state, {'c': CAST(0 AS BIGINT), 'a': ''} AS best FROM ids
  UNION ALL
  SELECT w.id, e.i, e.next, min({'c': CAST(w.best.c + e.price AS BIGINT), 'a': w.best.a || e.edit})
  FROM walk w JOIN edits e ON e.id = w.id AND e.i = w.i + 1 AND e.state = w.state
  GROUP BY w.id, e.i, e.next),
lasts AS (SELECT id, max(i) AS i FROM walk GROUP BY id),
won AS (
  SELECT id, min(best) AS best FROM walk JOIN lasts USING (id, i) WHERE state IN (0, 3) GROUP BY id),
stay AS (
  SELECT f.id, f.i, role, text, initial, substr(best.a, CAST(f.i AS INTEGER), 1) AS edit,
    row_number() OVER (PARTITION BY f.id ORDER BY f.i) AS j
  FROM f JOIN won USING (id) WHERE substr(best.a, CAST(f.i AS INTEGER), 1) <> 'D'),
heads AS (SELECT id, CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END AS shift FROM stay WHERE j = 1),
texts AS (
  SELECT id, string_agg((CASE WHEN edit = 'K' THEN role WHEN (j - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text,
    chr(10) ORDER BY j) AS body
  FROM stay JOIN heads USING (id) GROUP BY id),
sums AS (
  SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY id)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, best.c AS cost, best.a AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM ids JOIN won USING (id) LEFT JOIN sums USING (id) LEFT JOIN texts USING (id)
"""


@query("op12_conversation_repair", OP12_SQL)
def op12_conversation_repair(spark, sf):
    return summaries(repaired(damaged(table(spark, sf, "conversations"))))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT g FROM k GROUP BY g HAVING count(*) > 1),
gone AS (
  SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM k SEMI JOIN twice USING (g)) GROUP BY r),
m AS (
  SELECT doc_id, w, coalesce(len(ps), 0) AS n,
    CASE WHEN ps IS NULL THEN w ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda i: NOT map_contains(h, i))) END AS stay
  FROM (SELECT d.*, ps, map_from_entries(list_transform(ps, lambda p: {'k': p, 'v': 1})) AS h FROM d LEFT JOIN gone USING (r)))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed, sha256(array_to_string(stay, ' ')) AS kept_sha256
FROM m
"""


@query("op11_substring_dedup", OP11_SQL)
def op11_substring_dedup(spark, sf):
    cut = substring_dedup(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
