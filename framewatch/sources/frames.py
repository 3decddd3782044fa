"""Frame sources: the frame row contract, batch and streaming readers, and the
frames fixture derived from the driver's ``events`` and ``embeddings`` tables.

A frame row carries the six telemetry columns plus three keys that replace the
positional batch index of a pandas frame:

* ``seq``          long, arrival order inside a feed (never rely on DataFrame order)
* ``feed_id``      the source a batch was fetched from
* ``batch_round``  int, the batch number of the feed
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GateConfig
from .topology import known_rows, unknown_rows

# The six columns the quality gate checks, in contract order.
CONTRACT_COLUMNS = ("timestamp", "camera_id", "frame_id", "brightness_avg",
                    "blur_metric", "embedding")

FRAME_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("feed_id", T.StringType()),
    T.StructField("batch_round", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("frame_id", T.StringType()),
    T.StructField("brightness_avg", T.DoubleType()),
    T.StructField("blur_metric", T.DoubleType()),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
])

KEY_COLUMNS = ("feed_id", "batch_round", "seq")


def read_frames(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType | None = None) -> DataFrame:
    """Batch read of frame rows with a declared schema (no inference).  For
    files that break the contract pass their own ``schema``; the gate reports it."""
    return spark.read.format(fmt).schema(schema or FRAME_SCHEMA).load(path)


def stream_frames(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = None,
                  max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming read of the same layout; one file holds whole batches."""
    return (spark.readStream.format(fmt).schema(schema or FRAME_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# ---------------------------------------------------------------------------
# Fixture: frames derived from the driver tables (FIXTURES.md B1).
# ---------------------------------------------------------------------------
_EPOCH = "2024-01-01"


def frames_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project ``events`` ⋈ ``embeddings`` into frame rows.

    Every vector is used: the join key is ``event_id`` modulo the number of
    vectors (a count from the files' footers).  Catalyst decides the strategy
    from the file sizes.
    """
    vectors = max(1, spark.read.parquet(table_path(sf_dir, "embeddings")).count())
    ev = spark.read.parquet(table_path(sf_dir, "events")).select(
        "event_id", "ts", "user_id", "value", "props")
    vec = spark.read.parquet(table_path(sf_dir, "embeddings")).select(
        F.col("vec_id"), F.col("embedding").alias("vec"))

    k = F.get_json_object("props", "$.k").cast("int")
    cam = (F.col("user_id") % 16).cast("int")
    rnd = (F.datediff(F.to_date("ts"), F.lit(_EPOCH).cast("date")) + 1).cast("int")
    feed = F.concat(F.lit("camera_"), cam.cast("string"))

    base = (ev.withColumn("k", k).withColumn("cam", cam)
            .withColumn("batch_round", rnd).withColumn("feed_id", feed)
            .withColumn("vec_id", F.col("event_id") % vectors))
    shifted = (F.col("cam") == 5) & (F.col("batch_round") >= 15)
    dark = (F.col("cam") == 2) & (F.col("batch_round") >= 21)
    factor = F.lit(1.0) + (F.col("k") % 10).cast("double") / F.lit(10.0)
    vec_d = F.col("vec").cast("array<double>")
    vec_d = F.when(F.col("event_id") % 97 == 0, F.slice(vec_d, 1, 32)).otherwise(vec_d)
    emb = F.transform(vec_d, lambda x: x * F.col("factor"))
    emb = F.when(shifted, F.transform(emb, lambda x: x * F.lit(2.0))).otherwise(emb)

    return (base.join(vec, "vec_id", "left")
            .withColumn("factor", factor)
            .select(
                F.col("event_id").alias("seq"),
                "feed_id",
                "batch_round",
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                F.when(F.col("event_id") % 101 == 0,
                       F.concat(F.lit("cam_"), F.col("cam").cast("string")))
                 .otherwise(F.col("feed_id")).alias("camera_id"),
                F.concat(F.col("feed_id"), F.lit("_b"),
                         F.lpad(F.col("batch_round").cast("string"), 3, "0"),
                         F.lit("_f"), F.col("event_id").cast("string")).alias("frame_id"),
                F.when(dark, F.col("value") * F.lit(0.05))
                 .when(shifted, F.col("value") + F.lit(68.0))
                 .otherwise(F.col("value") + F.lit(8.0)).alias("brightness_avg"),
                F.when(shifted, (F.col("k") - 1).cast("double") / F.lit(100.0) + F.lit(0.4))
                 .otherwise((F.col("k") - 1).cast("double") / F.lit(100.0)).alias("blur_metric"),
                emb.alias("embedding"),
                F.col("ts").cast("timestamp").alias("event_ts"),
            ))


# ---------------------------------------------------------------------------
# Feed-level source operators.
# ---------------------------------------------------------------------------
def feed_subset(frames: DataFrame, feed_ids) -> DataFrame:
    """S3: one batch stream per requested feed, given as a list or as a table with a
    ``feed_id``.  On data written with ``partitionBy('feed_id')`` either prunes whole directories."""
    if isinstance(feed_ids, DataFrame):
        return frames.join(feed_ids.select("feed_id"), "feed_id", "left_semi").select(*frames.columns)
    return frames.where(F.col("feed_id").isin(list(feed_ids)))


def unknown_feeds(frames: DataFrame, cfg: GateConfig) -> DataFrame:
    """Rows fetched from a feed that is not configured (rejected)."""
    return unknown_rows(frames, "feed_id", cfg)


def accepted_feeds(frames: DataFrame, cfg: GateConfig) -> DataFrame:
    """The other side of :func:`unknown_feeds`."""
    return known_rows(frames, "feed_id", cfg)


def number_batches(frames: DataFrame, bucket: Column, chunk: Column) -> DataFrame:
    """Per-feed batch counter from an event-time bucket when the data has
    no round column.

    The counter is the running count of the feed's distinct buckets: a
    chunked prefix sum over (feed, bucket) pairs, so a feed with very many
    buckets is not one task.  ``chunk`` must be non-decreasing in the bucket
    (e.g. ``floor(unix_seconds(_bucket) / 86400)``); it may use ``_bucket``."""
    from ..operators.ordered import running_sums
    pairs = frames.select("feed_id", bucket.alias("_bucket")).distinct().withColumn("_bchunk", chunk)
    numbered = running_sums(pairs, "feed_id", ["_bucket"], F.col("_bchunk"), {"batch_round": F.lit(1)})
    numbered = numbered.select("feed_id", "_bucket", F.col("batch_round").cast("int").alias("batch_round"))
    return (frames.withColumn("_bucket", bucket)
            .join(numbered, ["feed_id", "_bucket"]).drop("_bucket"))


def latest_batch(frames: DataFrame) -> DataFrame:
    """Latest batch number per feed and the last frame of it.

    Hash aggregations only touch every row (per (feed, round): max seq,
    count); the last (round, seq) per feed is picked on that small result and
    its frame id fetched with a join against a table of one row per feed."""
    per_round = frames.groupBy("feed_id", "batch_round").agg(
        F.max("seq").alias("_seq"), F.count(F.lit(1)).alias("_n"))
    per_feed = per_round.groupBy("feed_id").agg(
        F.max("batch_round").alias("batch_number"),
        F.max(F.struct("batch_round", "_seq")).alias("_last"),
        F.sum("_n").alias("frame_count"))
    last = per_feed.select("feed_id", "batch_number", "frame_count",
                           F.col("_last.batch_round").alias("batch_round"),
                           F.col("_last._seq").alias("seq"))
    ids = frames.select("feed_id", "batch_round", "seq", F.col("frame_id").alias("last_frame_id"))
    return (last.join(ids, ["feed_id", "batch_round", "seq"], "left")
            .select("feed_id", "batch_number", "last_frame_id", "frame_count"))


def _input_version(spark: SparkSession, path: str) -> str:
    """Sizes and times of a table's files, by the file system that holds them."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    status = fs.getFileStatus(hpath)
    total = fs.getContentSummary(hpath)
    return f"{path}:{total.getLength()}:{total.getFileCount()}:{status.getModificationTime()}"


@contextmanager
def open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Writes inside keep up to ``n`` partition folders open a task, so wide rows are not sorted
    by folder, which spills more than is written; a task with more folders sorts the rest."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def frames_path(spark: SparkSession, sf_dir: str) -> str:
    """The frames fixture as a stored table (the ingest step): its path.

    In production frames arrive as a table; here they are derived from the
    driver tables once per input version and written as parquet, partitioned by
    feed, under the shared checkpoint folder (``spark.checkpoint.dir``).  The
    folder's name covers the input files' sizes and times.
    """
    from ..session import scratch_path

    parts = [FIXTURE_VERSION] + [_input_version(spark, table_path(sf_dir, n)) for n in ("events", "embeddings")]
    key = hashlib.sha256("|".join(parts).encode()).hexdigest()[:16]
    path = scratch_path(spark, f"frames-{key}")
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath(path + "/_SUCCESS")):
        # write aside, then one atomic rename: concurrent first users never
        # see (or clobber) a half-written table
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        with open_writers(spark, FEED_WRITERS):   # a task holds a row group a feed: small ones
            frames_from_events(spark, sf_dir).write.partitionBy("feed_id").options(**ROW_GROUPS).parquet(tmp)
        if not fs.rename(hpath(tmp), hpath(path)):
            fs.delete(hpath(tmp), True)  # another writer won; use its table
    return path


def frames_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored frames of ``sf_dir``; every query scans it with column pruning,
    filter pushdown and partition pruning by feed."""
    schema = T.StructType([*FRAME_SCHEMA.fields, T.StructField("event_ts", T.TimestampType())])
    return read_frames(spark, frames_path(spark, sf_dir), schema=schema).select(*schema.names)


FIXTURE_VERSION = "frames-v2"
#: The fixture has 16 feeds and one without a name.
FEED_WRITERS = 32
ROW_GROUPS = {"parquet.block.size": 4 << 20, "parquet.page.size": 256 << 10, "parquet.dictionary.page.size": 256 << 10}
