"""The registered queries, one per operator, over whole tables."""

from pyspark.sql import functions as F

from chatterscope.llm import sentencepiece, toxicity
from chatterscope.llm.common import table
from chatterscope.llm.decontamination import contamination
from chatterscope.llm.jaccard import near_copies
from chatterscope.llm.licenses import licences
from chatterscope.llm.pii import personal_data
from chatterscope.llm.quality import quality
from chatterscope.llm.registry import query
from chatterscope.llm.secrets import secrets
from chatterscope.llm.sentencepiece import load_vocabulary
from chatterscope.llm.sharding import kd_shards
from chatterscope.llm.suffix_dedup import dedup

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) CROSS JOIN ns WHERE i + n - 1 <= len(w)),
hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op1_decontamination", OP1_SQL)
def op1_decontamination(spark, sf):
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op4_toxicity")
def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = toxicity.train(docs, table(spark, sf, "labels").where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op6_pii")
def op6_pii(spark, sf):
    found = personal_data(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "pii.*").drop("masked")


@query("op9_quality")
def op9_quality(spark, sf):
    judged = quality(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels"))
    return judged.select("doc_id", "quality.*")


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op10_sentencepiece")
def op10_sentencepiece(spark, sf):
    found = sentencepiece.digests(table(spark, sf, "documents").select("doc_id", "text"), load_vocabulary(VOCABULARY))
    return found.select("doc_id", "pieces.*")


@query("op2_sharding")
def op2_sharding(spark, sf):
    return kd_shards(table(spark, sf, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_licenses")
def op3_licenses(spark, sf):
    return licences(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "licence.*")


@query("op8_secrets")
def op8_secrets(spark, sf):
    return secrets(table(spark, sf, "documents").select("doc_id", "text"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM d JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
LEFT JOIN c USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) USING (doc_id)
"""


@query("op5_jaccard", OP5_SQL)
def op5_jaccard(spark, sf):
    return near_copies(table(spark, sf, "documents"))


# Each 100-byte string by its digest; bytes as pairs of hexadecimal digits.
OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS g
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200)),
later AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM k) WHERE nth > 1),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM later),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM runs),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS z,
    string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS front
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


@query("op7_suffix_dedup", OP7_SQL)
def op7_suffix_dedup(spark, sf):
    return dedup(table(spark, sf, "documents")).drop("removed")
