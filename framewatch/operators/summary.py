"""Telemetry summaries and run totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_telemetry(valid: DataFrame, batches: DataFrame) -> DataFrame:
    """A5 + A6: per batch summary of the valid rows.

    Embedding mean/std are over all elements of all rows (population std,
    M23), combined from counts, means and sums of squared deviations, so large
    means cancel nothing: of each row's elements, of the rows of a camera id in
    a batch (``var_pop``), and of those groups.  All rows of a group have
    vectors of one length (the group key).  A batch with no valid row gets the
    defaults and the QA result's camera (left join from the batch table).

    The pass over all rows is a hash aggregation with fixed-width buffers; the
    summary camera (first valid row's id) is picked on its small result.  The
    frame ids of a batch are the rows of :func:`batch_frame_ids`.
    """
    n = F.size("embedding")
    rows = valid.select(
        "feed_id", "batch_round", "seq", F.coalesce("camera_id", F.lit("unknown")).alias("camera_id"),
        "brightness_avg", "blur_metric", "embedding", n.alias("_n"),
        (F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x) / n).alias("_mean"))
    rows = rows.withColumn("_m2", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean"))))
    l1 = rows.groupBy("feed_id", "batch_round", "camera_id", "_n").agg(
        F.count(F.lit(1)).alias("_c"), F.min("seq").alias("_first"), F.max("seq").alias("_last"),
        F.avg("brightness_avg").alias("_ab"), F.min("brightness_avg").alias("_mb"),
        F.avg("blur_metric").alias("_al"), F.avg("_mean").alias("_mean"),
        (F.sum("_m2") + F.col("_n") * F.count("_mean") * F.var_pop("_mean")).alias("_m2"),
        (F.col("_n") * F.count("_mean")).alias("_e"))
    batch = Window.partitionBy("feed_id", "batch_round")
    whole = F.sum(F.col("_mean") * F.col("_e")).over(batch) / F.sum("_e").over(batch)
    agg = l1.withColumn("_whole", whole).groupBy("feed_id", "batch_round").agg(
        F.min_by("camera_id", "_first").alias("_camera"),
        F.sum("_c").alias("frame_count"),
        F.min("_first").alias("first_seq"), F.max("_last").alias("last_seq"),
        (F.sum(F.col("_ab") * F.col("_c")) / F.sum("_c")).alias("brightness_avg_mean"),
        F.min("_mb").alias("brightness_avg_min"),
        (F.sum(F.col("_al") * F.col("_c")) / F.sum("_c")).alias("blur_metric_mean"),
        F.first("_whole").alias("embedding_mean"),
        F.sqrt((F.sum("_m2") + F.sum(F.col("_e") * (F.col("_mean") - F.col("_whole")) * (F.col("_mean") - F.col("_whole"))))
               / F.sum("_e")).alias("embedding_std"))
    out = batches.select("feed_id", "batch_round", F.col("camera_id").alias("_batch_camera")).join(
        agg, ["feed_id", "batch_round"], "left")
    zero = F.lit(0.0)
    return out.select(
        "feed_id", "batch_round",
        F.coalesce("_camera", "_batch_camera").alias("camera_id"),
        F.coalesce("frame_count", F.lit(0)).alias("frame_count"),
        "first_seq", "last_seq",
        F.coalesce("brightness_avg_mean", zero).alias("brightness_avg_mean"),
        F.coalesce("brightness_avg_min", zero).alias("brightness_avg_min"),
        F.coalesce("blur_metric_mean", zero).alias("blur_metric_mean"),
        F.coalesce("embedding_mean", zero).alias("embedding_mean"),
        F.coalesce("embedding_std", zero).alias("embedding_std"))


def pipeline_totals(batches: DataFrame, reports: DataFrame, incs: DataFrame) -> DataFrame:
    """A9 (+K12): run totals as (metric, value) rows — three global
    aggregates unioned, no join of single-row tables."""
    q = batches.agg(F.sum("quarantined_count").cast("bigint").alias("value")) \
        .select(F.lit("total_quarantined_rows").alias("metric"), "value")
    d = reports.agg(F.count_if(F.col("drift_detected")).cast("bigint").alias("value")) \
        .select(F.lit("drift_alert_count").alias("metric"), "value")
    i = incs.agg(F.count(F.lit(1)).cast("bigint").alias("value")) \
        .select(F.lit("total_incidents").alias("metric"), "value")
    return q.unionByName(d).unionByName(i)


def batch_frame_ids(valid: DataFrame) -> DataFrame:
    """A5: the frame ids of every batch as rows (a list per batch has no bound)."""
    return valid.select("feed_id", "batch_round", "seq", "frame_id")
