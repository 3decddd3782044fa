"""A corpus pipeline: documents in, token ids out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the docs of the next one.  Stages keep the columns of
the documents, whatever further columns there are; the last returns token ids.

Defined cases: null or empty texts fail the quality rules; of rows that repeat a doc_id
and its text one stays after the join, and unlike texts under one doc_id are documents of their own;
rows with a null doc_id are never taken for copies; an empty table passes through as an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewatch.llm import jaccard, mixing, quality, secret_scan, sentencepiece_bpe
from framewatch.llm.common import table, use_package
from framewatch.llm.queries import tokenizer_path
from framewatch.session import scratch_path

SIMILARITY = jaccard.Similarity(words=5, percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.quality_rules(docs, table(spark, sf_dir, "labels")).where("kept").select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the one with the smallest id stays."""
    use_package(spark)
    similar = jaccard.similar_rows(docs, SIMILARITY).where("node is not null").select("node", F.struct("doc_id", "h").alias("text"))
    first = similar.groupBy("node").agg(F.min("text").alias("first"))
    copies = similar.join(first, "node").where(F.col("text") != F.col("first")).select(
        F.col("text.doc_id").alias("_copy"), F.col("text.h").alias("_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    left = rows.where("_id is not null").join(copies, (F.col("_id") == F.col("_copy")) & (F.col("_h") == F.col("_hash")), "left_anti")
    # rows of one id and text are one document
    number = F.row_number().over(Window.partitionBy("_id", "_h").orderBy(F.xxhash64("row.source", "row.lang")))
    left = left.withColumn("_first", number).where("_first = 1").select("row.*")
    return left.unionByName(rows.where("_id is null").select("row.*"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    rows = secret_scan.redact(docs.select(F.struct("*").alias("row"), "text")).withColumnRenamed("text", "_text")
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast(docs.schema["n_chars"].dataType)}
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as the mix takes it: not, once or twice."""
    sizes = mixing.word_sizes(docs)
    taken = mixing.mix_sources(sizes).where("copies > 0").select(*[
        F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "size", "k", "copies")])
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("from"),
                       F.size(mixing.words(F.col("text"))).cast("long").alias("size"))
    number = F.row_number().over(Window.partitionBy("id", "from", "size").orderBy(F.xxhash64("row.text")))
    rows = rows.withColumn("number", number.cast("long"))
    joined = rows.join(taken, F.col("id").eqNullSafe(F.col("_doc_id")) & F.col("from").eqNullSafe(F.col("_source"))
                       & (F.col("size") == F.col("_size")) & (F.col("number") == F.col("_k")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), "_copies"))).select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (binary, little-endian 32-bit), read back once."""
    use_package(spark)
    coded = sentencepiece_bpe.encode_texts(docs.select("doc_id", "text"), tokenizer_path())
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Hashed multinomials, dependent rounding and the merges of the vocabulary are not
#: for SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"llm/pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
