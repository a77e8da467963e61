"""The registered queries of these operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, conversations, decontaminate, embeddings, fingerprints, language, packing, quality, resampling, secrets, sharding, simhash, tokens, warc


def tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rest = common.crc_remainder("doc_id", 3)
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), quality.fit(docs, labels.where(rest != 1)))
    return scored.select("doc_id", (rest == 1).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = common.crc_remainder("doc_id", 4)
    found = language.predict(docs.select("doc_id", "text"), language.learn(docs.where(rest != 2)))
    return found.select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_after_edits(table(spark, sf_dir, "documents"), tokenizer())


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer())


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_report(table(spark, sf_dir, "documents"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_embedding_near_dedup, op3_quality, op4_language, op5_simhash, op6_warc, op7_decontamination, op8_token_counts, op9_packing, op10_secrets, op11_document_fingerprints, op12_importance_resampling, op13_prefix_trie)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: CTEs for crc32 of strings: the table of 256 remainders, and an expression over it.
_CRC_TABLE = """bit AS (SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crc_of FROM bit WHERE k = 8)"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({0}))),
  lambda i: ('0x' || substr(hex(encode({0})), (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda c, x: xor(c >> 8, crc_of[xor(c & 255, x) + 1])), 4294967295)"""

SQL = {
    "op2_embedding_near_dedup": """
WITH RECURSIVE able AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reach AS (SELECT a AS node, a AS seen FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(least.component, e.vec_id)::BIGINT AS component_id, coalesce(least.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least ON least.node = e.vec_id""",
    "op6_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""",
    "op7_decontamination": rf"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc CROSS JOIN (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
occ AS (SELECT a.doc_id, a.i, a.k, win.item FROM place a JOIN win ON a.s = win.s AND a.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT doc.doc_id, coalesce(len(doc.w), 0)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
  sha256(coalesce(named.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_importance_resampling": rf"""
WITH RECURSIVE {_CRC_TABLE},
doc AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
item AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
bucket AS (SELECT w, {_CRC.format("w")} % 10000 AS b FROM (SELECT w FROM doc UNION SELECT w FROM item), crc_table),
s AS (SELECT b, count(*) AS s FROM doc JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM item JOIN bucket USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM doc) + 10000)::DOUBLE / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM item) + 10000)::DOUBLE))) AS gain
  FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
weight AS (SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM doc JOIN bucket USING (w) JOIN gain USING (b) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weight USING (doc_id)),
placed AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(place) * 10 // 100 FROM placed) THEN place END AS rank FROM placed""",
    "op13_prefix_trie": rf"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT c, n, {_CRC.format("c::VARCHAR")} % 9 AS h FROM (SELECT c, count(*) AS n FROM turns GROUP BY c), crc_table),
plan AS (SELECT conv.c, conv.h, least(conv.h, coalesce(base.n, 0)) AS m FROM conv LEFT JOIN conv base ON base.c = conv.c - conv.c % 5),
rebuilt AS (SELECT plan.c, pos AS d, role, text FROM plan JOIN turns ON turns.c = plan.c - plan.c % 5 AND pos <= h
  UNION ALL SELECT plan.c, m + pos - h, role, text FROM plan JOIN turns ON turns.c = plan.c AND pos > h),
path AS (SELECT c, 0::BIGINT AS d, sha256('') AS key, NULL::VARCHAR AS parent, 0::BIGINT AS bytes FROM plan
  UNION ALL SELECT path.c, rebuilt.d, sha256(path.key || sha256(role) || sha256(text)), path.key, octet_length(encode(text)) FROM path JOIN rebuilt ON rebuilt.c = path.c AND rebuilt.d = path.d + 1),
node AS (SELECT key, min(c) AS c, max(d) AS d, count(*) AS n, max(parent) AS parent, max(bytes) AS bytes FROM path GROUP BY key),
long AS (SELECT c, max(d) AS d FROM path GROUP BY c),
ends AS (SELECT key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM path JOIN long USING (c, d) GROUP BY key),
kids AS (SELECT parent AS key, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
under AS (SELECT a.key, sum((kids.n IS NULL)::INT) AS leaves, sum((v.n - 1) * v.bytes) AS saved
  FROM node v LEFT JOIN kids ON kids.key = v.key JOIN path a ON a.c = v.c AND a.d <= v.d GROUP BY a.key)
SELECT v.c AS conv_id, v.d AS depth, above.c AS parent_conv_id, v.n AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, under.leaves::BIGINT AS n_leaves,
  under.saved::BIGINT AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node v LEFT JOIN node above ON above.key = v.parent LEFT JOIN kids ON kids.key = v.key LEFT JOIN ends ON ends.key = v.key JOIN under ON under.key = v.key""",
}
