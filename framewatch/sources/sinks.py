"""Sinks and read-back (S8..S12).

Per-row files of a single-machine pipeline become partitioned tables: one
write per table, partitioned by round and feed (whole batches), so a cluster
writes in parallel and readers prune partitions.  A row's own camera id may be
anything, so it stays a column.  A batch that is written again replaces its
partition, so a replay leaves the table as it was.  Incidents and requests have
a folder per id, which a replay or a second writer replaces by the same row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import RULES_TYPE
from .frames import FRAME_SCHEMA

QUARANTINE_ROW_COLUMNS = ["feed_id", "batch_round", "seq", "timestamp", "camera_id", "frame_id",
                          "brightness_avg", "blur_metric", "embedding"]

QUARANTINE_SCHEMA = T.StructType([f for f in FRAME_SCHEMA if f.name in QUARANTINE_ROW_COLUMNS])

REASON_SCHEMA = T.StructType([
    T.StructField("feed_id", T.StringType()),
    T.StructField("batch_round", T.IntegerType()),
    T.StructField("row_index", T.LongType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("frame_id", T.StringType()),
    T.StructField("failed_rules", RULES_TYPE),
    T.StructField("quarantined_at", T.StringType()),
])


def _write_batches(df: DataFrame, path: str, fmt: str) -> None:
    """One folder per batch, replaced whole.  Rows are dealt out by batch, so a
    folder gets few files; a batch too large for one task is split again."""
    (df.hint("rebalance", "batch_round", "feed_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_round", "feed_id").format(fmt).save(path))


def write_quarantine_rows(quarantined: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Quarantined frames, partitioned by round and feed."""
    _write_batches(quarantined.select(*QUARANTINE_ROW_COLUMNS), path, fmt)


def write_quarantine_reasons(reasons: DataFrame, path: str, fmt: str = "json") -> None:
    """One reason record per quarantined row (JSON lines by default)."""
    _write_batches(reasons, path, fmt)


def _one_per_id(df: DataFrame, id_col: str) -> DataFrame:
    """``row`` of each id with the digest that names its folder, and the folder's bucket.
    A row without an id is known by its content.  Of unlike rows with one id the first by
    its JSON text is taken."""
    row = F.struct(*[F.col(c) for c in df.columns])
    key = F.coalesce(F.concat(F.lit("id:"), F.col(id_col)), F.concat(F.lit("row:"), F.to_json(row)))
    rows = df.select(F.sha2(key, 256).alias("id_key"), row.alias("row"))
    return rows.groupBy(F.substring("id_key", 1, 2).alias("id_bucket"), "id_key").agg(F.min_by("row", F.to_json("row")).alias("row"))


def _write_by_id(df: DataFrame, path: str, id_col: str, fmt: str) -> None:
    """One folder per id, in buckets, replaced whole by whoever writes the id again.

    Nothing is read before, so writers need no order among them: those of unlike
    ids touch unlike folders, and those of one id each leave that id's row."""
    (_one_per_id(df, id_col).select("row.*", "id_bucket", "id_key").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("id_bucket", "id_key").format(fmt).save(path))


def write_incidents(payloads: DataFrame, path: str, fmt: str = "json") -> None:
    """Incident payloads, one row per ``incident_id`` however often it is written."""
    _write_by_id(payloads, path, "incident_id", fmt)


def write_retrain_requests(requests: DataFrame, path: str, fmt: str = "json") -> None:
    """Retraining requests, one row per ``request_id`` however often it is written."""
    _write_by_id(requests, path, "request_id", fmt)


def read_quarantine_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read back quarantined frames with their declared schema."""
    return spark.read.format(fmt).schema(QUARANTINE_SCHEMA).load(path).select(*QUARANTINE_ROW_COLUMNS)


def read_quarantine_reasons(spark: SparkSession, path: str) -> DataFrame:
    """Read back reason records with their declared schema."""
    return spark.read.schema(REASON_SCHEMA).json(path).select(*REASON_SCHEMA.names)


def read_json_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a plain JSON table with a schema."""
    return spark.read.schema(schema).json(path)


def read_alerts(spark: SparkSession, path: str, schema: T.StructType, id_col: str, fmt: str = "json") -> DataFrame:
    """Read back incidents or requests, one row per id.  (Two writers that replace one id's
    folder at the same moment can leave both files in it.)"""
    files = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", "true").load(path)
    return _one_per_id(files, id_col).select("row.*")
