"""Rolling quarantine rate, breaker evaluation and the latched breaker.

Everything here runs on the *batch* table (one row per feed and round), which
is orders of magnitude smaller than the frames.  The per-camera order
(record ordinals, the 5-record frame, the running trip count that forms the
latch) is computed with chunked prefix sums and halo frames
(``ordered.py``), so a camera with a very large share of the batches is
spread over many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import GateConfig
from ..functions.text import percent_text, round4
from ..sources import topology
from .ordered import halo_window, running_sums
from .qa import breaker_input


def _round_chunk(cfg: GateConfig) -> Column:
    return F.floor(F.col("batch_round") / F.lit(cfg.chunk_rounds))


def rolling_quarantine_rate(records: DataFrame, cfg: GateConfig) -> DataFrame:
    """W1 (M9): Σquarantined / Σtotal over the last N *records* of a camera,
    0.0 when those records hold no rows.  Ratio of sums, not mean of rates.

    Record ordinals per camera are a chunked prefix count; the N-record frame
    runs per (camera, ordinal chunk) with an N-1 halo (bounded partitions)."""
    r = running_sums(topology.with_place(records, cfg), "camera_id", topology.stream_order(), _round_chunk(cfg),
                     {"record_ordinal": F.lit(1)}).drop(topology.PLACE)
    span = cfg.qa_window_batches - 1
    out = halo_window(r, "camera_id", "record_ordinal", span, cfg.chunk_records, {
        "_q": lambda w: F.sum("quarantined_count").over(w),
        "_t": lambda w: F.sum(F.col("valid_count") + F.col("quarantined_count")).over(w)})
    return (out.withColumn("rolling_quarantine_rate",
                           F.when(F.col("_t") == 0, F.lit(0.0)).otherwise(F.col("_q").cast("double") / F.col("_t")))
            .drop("_q", "_t"))


def latest_drift_per_camera(reports: DataFrame, cfg: GateConfig) -> DataFrame:
    """When several reports name the same camera in a round, the last
    one (configured feed order) wins."""
    cols = [c for c in reports.columns if c not in ("camera_id", "batch_round")]
    return (topology.with_place(reports, cfg).groupBy("camera_id", "batch_round")
            .agg(F.max_by(F.struct(*cols), F.struct(topology.PLACE, "feed_id")).alias("_d"))
            .select("camera_id", "batch_round", "_d.*")
            .drop("feed_id"))


def qa_with_drift(records: DataFrame, reports: DataFrame | None, cfg: GateConfig) -> DataFrame:
    """Batch record ⟕ the camera's drift report of the same round."""
    if reports is None:
        return records
    d = latest_drift_per_camera(reports, cfg).select(
        "camera_id", "batch_round",
        F.col("status").alias("drift_status"),
        F.col("drift_detected"),
        F.col("window_size").alias("drift_window_size"),
        *[F.col(f"{f}_drift") for f in C.DRIFT_FEATURES],
        F.col("features").alias("drift_features"))
    return records.join(d, ["camera_id", "batch_round"], "left")


def drifted_features_expr(df: DataFrame) -> Column:
    """Drifted feature names in fixed feature order; empty unless the
    report was analyzed and flagged drift."""
    if "drift_status" not in df.columns:
        return F.array().cast("array<string>")
    names = F.filter(F.array(*[F.when(F.col(f"{f}_drift"), F.lit(f)) for f in C.DRIFT_FEATURES]),
                     lambda x: x.isNotNull())
    return F.when((F.col("drift_status") == "analyzed") & F.col("drift_detected"), names) \
            .otherwise(F.array().cast("array<string>"))


def reason_structs(cfg: GateConfig) -> Column:
    """Reasons in rate-then-drift order; one struct type, unused fields null."""
    rate = F.col("rolling_quarantine_rate")
    feats = F.col("drifted_features")
    n = F.size(feats)
    rate_msg = F.format_string(C.RATE_MESSAGE.replace("{rate}", "%s").replace("{threshold}", "%s"),
                               percent_text(rate), percent_text(F.lit(cfg.rate_threshold)))
    drift_msg = F.format_string(C.DRIFT_MESSAGE.replace("{count}", "%d").replace("{features}", "%s"),
                                n, F.array_join(feats, ", "))
    rate_reason = F.when(rate > F.lit(cfg.rate_threshold), F.struct(
        F.lit(C.REASON_RATE).alias("type"),
        F.col("camera_id").alias("camera_id"),
        round4(rate).alias("observed_rate"),
        F.lit(float(cfg.rate_threshold)).alias("threshold"),
        F.lit(None).cast("array<string>").alias("features"),
        F.lit(None).cast("int").alias("feature_count"),
        rate_msg.alias("message")))
    drift_reason = F.when(n >= F.lit(cfg.min_drift_features), F.struct(
        F.lit(C.REASON_DRIFT).alias("type"),
        F.col("camera_id").alias("camera_id"),
        F.lit(None).cast("double").alias("observed_rate"),
        F.lit(float(cfg.min_drift_features)).alias("threshold"),
        feats.alias("features"),
        n.cast("int").alias("feature_count"),
        drift_msg.alias("message")))
    return F.filter(F.array(rate_reason, drift_reason), lambda x: x.isNotNull())


def breaker_evaluation(batches: DataFrame, cfg: GateConfig,
                       drift_reports: DataFrame | None = None) -> DataFrame:
    """I1 + W5..W7 in one pass over the known-camera batch records.

    Adds ``rolling_quarantine_rate``, ``drifted_features``, ``reasons``,
    ``should_trip``, ``trip_ordinal`` (1 = the incident, >1 = suppressed while
    the latched breaker is open) and ``breaker_state`` (closed/tripped/open).
    """
    recs = rolling_quarantine_rate(breaker_input(batches, cfg), cfg)
    recs = qa_with_drift(recs, drift_reports, cfg)
    recs = recs.withColumn("drifted_features", drifted_features_expr(recs))
    recs = recs.withColumn("reasons", reason_structs(cfg))
    recs = recs.withColumn("should_trip", F.size("reasons") > 0)
    # the latch: running count of trips per camera (chunked prefix sum)
    recs = running_sums(topology.with_place(recs, cfg), "camera_id", topology.stream_order(), _round_chunk(cfg),
                        {"trips": F.col("should_trip").cast("int")}).drop(topology.PLACE)
    return latch_columns(recs)


def latch_columns(recs: DataFrame) -> DataFrame:
    """W5..W7 from ``trips``, a camera's trips up to and with a record."""
    recs = recs.withColumn("trip_ordinal", F.when(F.col("should_trip"), F.col("trips")))
    return recs.withColumn(
        "breaker_state",
        F.when(F.col("trip_ordinal") == 1, F.lit("tripped"))
         .when(F.col("trips") > 0, F.lit("open")).otherwise(F.lit("closed"))).drop("trips")


def breaker_trips(evaluated: DataFrame) -> DataFrame:
    """W5 (M12): the first tripping record of each camera — one incident per
    camera, ever (the latch has no reset)."""
    return evaluated.where(F.col("trip_ordinal") == 1)


def breaker_suppressed(evaluated: DataFrame) -> DataFrame:
    """Later trips while the breaker is open (no new incident)."""
    return evaluated.where(F.col("trip_ordinal") > 1)
