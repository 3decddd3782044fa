"""The registered queries of this subpackage, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, embed_dedup, fill_middle, hard_negatives, jaccard, langid, lmscore, mixing, nearest, quality, secret_scan,
               sentencepiece_bpe, warc)
from .common import table

#: A conversation whose texts hold the template's control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), jaccard.Similarity(words=3, percent=90))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.conversation_digests(rows.unionByName(own))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(documents, table(spark, sf_dir, "labels")).select(F.col("row.doc_id").alias("doc_id"), "*").drop("row")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, sf_dir, "documents"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.middle_digests(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [op1_language_id, op2_embedding_near_dedup, op3_ngram_jaccard_join, op4_warc, op5_chat_formatting,
            op6_quality_rules, op7_lm_scoring, op8_mixing, op9_sentencepiece, op10_secret_scan,
            op11_nearest, op12_hard_negatives, op13_fill_middle]
    return {f.__name__: f for f in made}


def _secret_sql(scan: secret_scan.SecretScan = secret_scan.SecretScan()) -> str:
    """The scan in SQL: places of matches from the text between them, entropies of
    every window counted anew, and overlapping windows joined as islands."""
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def matches(name: str, pattern: str) -> str:
        return f"""
{name}_all AS (SELECT doc_id, string_split_regex(t, {text(pattern)}) AS gaps, regexp_extract_all(t, {text(pattern)}) AS found FROM t),
{name}_at AS (
  SELECT doc_id, found[i] AS v, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM {name}_all)),"""

    limit = "CASE " + " ".join(f"WHEN regexp_full_match(v, {text(p)}) THEN {b}" for p, b in scan.classes) + " ELSE 99 END"
    allowed = " OR ".join(f"regexp_full_match(v, {text(p)})" for p in scan.allowed)
    w = scan.window
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),{matches("a", secret_scan.ASSIGN)}{matches("k", secret_scan.ACCESS)}{
        matches("h", secret_scan.HEX)}{matches("r", scan.run)}
windows AS (
  SELECT doc_id, s AS run, s + i AS s, lim, string_split(substr(v, CAST(i + 1 AS BIGINT), {w}), '') AS c
  FROM (SELECT *, {limit} AS lim, unnest(range(0, length(v) - {w} + 1)) AS i FROM r_at WHERE NOT ({allowed}))),
high AS (
  SELECT doc_id, run, s FROM windows
  WHERE -list_sum(list_transform(list_distinct(c), lambda x: len(list_filter(c, lambda y: y = x)) / {w}.0
    * log2(len(list_filter(c, lambda y: y = x)) / {w}.0))) >= lim - 1e-9),
islands AS (
  SELECT *, sum(CASE WHEN s - before <= {w} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, run ORDER BY s) AS island
  FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id, run ORDER BY s) AS before FROM high)),
spans AS (
  SELECT doc_id, 0 AS kind, s, s + length(v) AS e FROM a_at WHERE length(regexp_extract(v, {text(secret_scan.ASSIGN)}, 2)) >= 6
  UNION ALL SELECT doc_id, 1, s, s + length(v) FROM k_at WHERE length(v) >= 20
  UNION ALL SELECT doc_id, 2, s, s + length(v) FROM h_at
  UNION ALL SELECT doc_id, 3, min(s), max(s) + {w} FROM islands GROUP BY doc_id, run, island),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e AS x FROM spans),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
    string_agg(x, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base, string_agg(x, ',' ORDER BY s, kind, e) AS every
  FROM named GROUP BY doc_id)
SELECT t.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM t LEFT JOIN joined ON joined.doc_id = t.doc_id"""


SQL = {
    "op2_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0),
h AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM h a JOIN h b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
r AS (
  SELECT vec_id AS id, vec_id AS c FROM embeddings
  UNION
  SELECT l.b, r.c FROM r JOIN l ON r.id = l.a),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, m.c AS component_id, e.vec_id = m.c AS kept
FROM embeddings e LEFT JOIN k ON k.a = e.vec_id
JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = e.vec_id""",
    "op3_ngram_jaccard_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT b.a, b.b FROM b JOIN n x ON x.doc_id = b.a JOIN n y ON y.doc_id = b.b WHERE 100 * b.k >= 90 * (x.n + y.n - b.k)),
r AS (
  SELECT doc_id AS id, doc_id AS c FROM documents
  UNION
  SELECT l.b, r.c FROM r JOIN l ON r.id = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT p.page_id, CAST(octet_length(encode(p.h)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    ((CAST('0x' || substr(p.x, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) // CAST(pow(32, 3 - i % 4) AS BIGINT)) % 32) + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p JOIN f ON f.h = p.h""",
    "op5_chat_formatting": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, turn, role, text,
    regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS r,
    regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS x FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(17 + length(r) + length(x)) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op10_secret_scan": _secret_sql(),
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_fill_middle": fill_middle.SQL,
}
