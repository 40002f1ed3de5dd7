"""The queries of the training-data operators over the driver's tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, exact_dedup, fingerprint, hard_negatives, importance, lm_scoring, neardup, packing, quality, token_files, toxicity, warc
from .common import load


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_score(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.train(documents, load(spark, sf_dir, "labels"))
    return toxicity.scored(documents, net).select("doc_id", "held_out", "score", "predicted")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    return chat_format.read_back(chat_format.format_chats(chat_format.events_of_turns(turns.unionByName(own))))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(load(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(documents, load(spark, sf_dir, "labels"))
    return quality.scored(documents, model).select("doc_id", "held_out", "score", "predicted")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.archive_pages(load(spark, sf_dir, "pages").select("page_id", "url", "html")))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents").select("doc_id", "text"), _vocabulary("byte_bpe_50k.json"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_dedup(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark").select("text")).select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_files(token_files.write_documents(load(spark, sf_dir, "documents").select("doc_id", "text"), _vocabulary("word_bpe_49k.json")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), lambda key: key % 100 == 0)


_QUERIES = (
    op1_lm_scoring, op2_toxicity, op3_chat_format, op4_bpe, op5_exact_dedup, op6_quality, op7_warc, op8_fingerprint, op9_packing, op10_minhash, op11_resampling,
    op12_token_files, op13_hard_negatives,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


_OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS body,
    replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(4 + length(head) + 2 + length(body) + 8) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""

_OP5_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q
"""


#: crc32 of the features byte by byte; its table of 256 entries is made by its rule.
_OP11_SQL = """
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
each AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
features AS (SELECT side, id, f, count(*) AS n FROM each GROUP BY ALL),
hex AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
bytes AS (SELECT f, list_transform(range(0, len(h) // 2), lambda i: 16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1) AS b FROM hex),
buckets AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, entries[CAST(xor(c & 255, x) AS BIGINT) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
counts AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 't') AS t FROM features JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000.0::DOUBLE) / ((coalesce(s, 0) + 1.0::DOUBLE) * (t_all + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM counts, totals),
summed AS (
  SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN summed ON doc_id = id WHERE side = 'd'),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM placed
"""

_OP13_SQL = """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM fine a JOIN fine r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER found AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW found AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER found <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": _OP3_SQL, "op5_exact_dedup": _OP5_SQL, "op7_warc": _OP7_SQL, "op11_resampling": _OP11_SQL, "op13_hard_negatives": _OP13_SQL}
