"""Query catalog: one named DataFrame per operator of the inventory.

Every entry is ``fn(spark, sf_dir) -> DataFrame`` and reads the driver's
tables through the frames projection, so its work grows with them.  Column
names and rounding match the oracle SQL in :mod:`framewatch.plans.oracle`.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG
from ..functions import rules as R
from ..functions.text import compact_utc, iso_utc, percent_text, round4, frame_id as fmt_frame_id
from ..operators import breaker, drift, qa
from ..session import scratch_path
from ..sources import frames as S
from ..sources import topology
from .pipeline import GatePipeline

CFG = FIXTURE_CONFIG
QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def registry() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def _p(spark, sf) -> GatePipeline:
    return GatePipeline.from_sf(spark, sf, CFG)


def _checks(col: str = "failed_rules", with_column: bool = False) -> Column:
    if with_column:
        return F.array_join(F.transform(col, lambda r: F.concat(r["column"], F.lit(":"), r["check"])), ",")
    return F.array_join(F.transform(col, lambda r: r["check"]), ",")


# ---------------------------------------------------------------------------
# Sources (S*)
# ---------------------------------------------------------------------------
@query("frames_scan")
def q_frames_scan(spark, sf):
    f = S.frames_table(spark, sf)
    return f.select("seq", "feed_id", "batch_round", "timestamp", "camera_id", "frame_id",
                    "brightness_avg", "blur_metric",
                    F.size("embedding").alias("embedding_dim"),
                    F.round(drift.norm_expr("embedding"), 9).alias("embedding_norm"))


@query("feed_subset")
def q_feed_subset(spark, sf):
    f = S.feed_subset(S.frames_table(spark, sf), ["camera_1", "camera_2", "camera_3"])
    return f.select("seq", "feed_id", "batch_round", "frame_id")


@query("unknown_feeds")
def q_unknown_feeds(spark, sf):
    # with only the first twelve feeds configured, the rows of the others are rejected
    cfg = CFG.with_(known_cameras=CFG.known_cameras[:12])
    return (S.unknown_feeds(S.frames_table(spark, sf), cfg)
            .select("seq", "feed_id", "batch_round", "camera_id", "frame_id"))


@query("topology_batches")
def q_topology_batches(spark, sf):
    # a topology table of the data: feeds below the average number of frames are retired, small ones come first
    sizes = S.frames_table(spark, sf).groupBy("feed_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    least = sizes.agg(F.avg("n")).scalar()
    path = scratch_path(spark, f"topology-{uuid.uuid4().hex}")
    topology.write_topology(sizes.select(F.col("feed_id").alias("camera_id"), F.when(F.col("n") >= least, F.col("n")).otherwise(-1).alias("place")), path)
    cfg = CFG.with_(topology=path)
    batches = GatePipeline.from_sf(spark, sf, cfg).batch_plan
    rates = breaker.rolling_quarantine_rate(breaker.breaker_input(batches, cfg), cfg)
    return topology.with_place(rates, cfg, "place").select(
        "camera_id", "feed_id", "batch_round", "place", F.round("rolling_quarantine_rate", 9).alias("rolling_quarantine_rate"))


@query("batch_numbering")
def q_batch_numbering(spark, sf):
    f = S.frames_table(spark, sf)
    hour = F.date_trunc("hour", "event_ts")
    # chunk = day of the bucket (monotone in the bucket)
    numbered = S.number_batches(f.drop("batch_round"), hour,
                                chunk=F.floor(F.unix_seconds(F.col("_bucket").cast("timestamp")) / F.lit(86400)))
    return numbered.select("seq", "feed_id", F.col("batch_round").alias("batch_number"))


@query("latest_batch")
def q_latest_batch(spark, sf):
    return S.latest_batch(S.frames_table(spark, sf))


@query("quarantine_reasons")
def q_quarantine_reasons(spark, sf):
    p = _p(spark, sf)
    r = qa.quarantine_reasons(p.gated, p.batch_plan)
    return r.select("feed_id", "batch_round", "row_index", "camera_id", "frame_id",
                    _checks().alias("checks"), "quarantined_at")


# ---------------------------------------------------------------------------
# Rules and projections (F*)
# ---------------------------------------------------------------------------
@query("clamp")
def q_clamp(spark, sf):
    f = S.frames_table(spark, sf)
    return f.select("seq", R.clamp(F.col("brightness_avg"), CFG.brightness_min, CFG.brightness_max)
                    .alias("brightness_clamped"),
                    R.clamp(F.col("blur_metric"), CFG.blur_min).alias("blur_clamped"))


def _rule_q(spark, sf, col: str, ok: Column, value: Column | None = None) -> DataFrame:
    f = S.frames_table(spark, sf)
    return f.select("seq", "feed_id", "batch_round", (value if value is not None else F.col(col)).alias(col),
                    ok.alias("passed"))


@query("rule_brightness")
def q_rule_brightness(spark, sf):
    return _rule_q(spark, sf, "brightness_avg", R.brightness_ok(F.col("brightness_avg"), CFG))


@query("rule_blur")
def q_rule_blur(spark, sf):
    return _rule_q(spark, sf, "blur_metric", R.blur_ok(F.col("blur_metric"), CFG))


@query("rule_camera_id")
def q_rule_camera_id(spark, sf):
    return _rule_q(spark, sf, "camera_id", R.camera_id_ok(F.col("camera_id"), CFG))


@query("rule_embedding_dim")
def q_rule_embedding_dim(spark, sf):
    return _rule_q(spark, sf, "embedding_dim", R.embedding_dim_ok(F.col("embedding"), CFG),
                   F.size("embedding"))


@query("rule_not_null")
def q_rule_not_null(spark, sf):
    f = S.frames_table(spark, sf)
    missing = [R.is_missing(F.col(c), f.schema[c].dataType) for c in S.CONTRACT_COLUMNS]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    return f.select("seq", "feed_id", "batch_round", (~any_missing).alias("passed"))


@query("coerce_types")
def q_coerce_types(spark, sf):
    # text columns cast through try_cast: numbers survive, ids become null
    f = S.frames_table(spark, sf).select(
        "seq", F.col("brightness_avg").cast("string").alias("brightness_avg"),
        F.col("blur_metric").cast("string").alias("blur_metric"), "frame_id")
    c = R.coerce_types(f)
    return c.select("seq", "brightness_avg", "blur_metric",
                    F.col("frame_id").try_cast("double").alias("frame_id_as_double"))


@query("rule_failures")
def q_rule_failures(spark, sf):
    g = _p(spark, sf).gated
    e = g.select("feed_id", "batch_round", "seq", F.explode("failed_rules").alias("r"))
    return e.select("feed_id", "batch_round", "seq", F.col("r.column").alias("column"),
                    F.col("r.check").alias("check"),
                    F.col("r.failure_case").try_cast("double").alias("failure_value"),
                    F.when(F.col("r.column") == "camera_id", F.col("r.failure_case")).alias("failure_text"))


@query("valid_frames")
def q_valid_frames(spark, sf):
    return _p(spark, sf).valid.select("seq", "feed_id", "batch_round", "camera_id", "frame_id",
                                      "brightness_avg", "blur_metric")


@query("quarantined_frames")
def q_quarantined_frames(spark, sf):
    q = _p(spark, sf).quarantined
    return q.select("seq", "feed_id", "batch_round", "camera_id", "frame_id", "brightness_avg",
                    "blur_metric", F.size("failed_rules").alias("n_rules"), _checks().alias("checks"))


@query("breaker_input")
def q_breaker_input(spark, sf):
    return qa.breaker_input(_p(spark, sf).batch_plan, CFG)


@query("custom_rule")
def q_custom_rule(spark, sf):
    rule = R.custom_rule("brightness_avg", "bright_and_blurry",
                         "NOT (brightness_avg > 60.0D AND blur_metric > 0.9D)")
    f = S.frames_table(spark, sf)
    g = R.evaluate_rules(f, CFG, [rule], coerce=False)
    # passed = the custom rule did not fire (other contract failures ignored here)
    fired = F.exists("failed_rules", lambda r: r["check"] == "bright_and_blurry")
    return g.select("seq", "feed_id", "batch_round", (~fired).alias("passed"))


@query("embedding_elements")
def q_embedding_elements(spark, sf):
    v = _p(spark, sf).valid
    e = v.select(F.posexplode("embedding").alias("pos", "x"))
    return e.groupBy("pos").agg(F.round(F.avg("x"), 9).alias("mean_value"),
                                F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Aggregations (A*)
# ---------------------------------------------------------------------------
@query("failure_alerts")
def q_failure_alerts(spark, sf):
    a = qa.failure_alerts(_p(spark, sf).gated)
    return a.select("feed_id", "batch_round", "row_index", F.size("failed_rules").alias("n_rules"),
                    _checks(with_column=True).alias("rules"))


@query("qa_batches")
def q_qa_batches(spark, sf):
    b = _p(spark, sf).batch_plan
    return b.select("feed_id", "batch_round", "camera_id", "status", "valid_count",
                    "quarantined_count", "total_count", F.round("quarantine_rate", 9).alias("quarantine_rate"))


@query("batch_quarantine_rate")
def q_batch_quarantine_rate(spark, sf):
    b = _p(spark, sf).batch_plan
    return b.select("feed_id", "batch_round", "total_count",
                    F.round("quarantine_rate", 9).alias("quarantine_rate"))


@query("rule_failure_counts")
def q_rule_failure_counts(spark, sf):
    p = _p(spark, sf)
    return qa.rule_failure_counts(p.gated, p.batch_plan)


# ---------------------------------------------------------------------------
# Joins / set-like ops (J*, O*)
# ---------------------------------------------------------------------------
def _without_blur(spark, sf) -> GatePipeline:
    return GatePipeline(spark, S.frames_table(spark, sf).drop("blur_metric"), CFG)


@query("row_rules_fallback")
def q_row_rules_fallback(spark, sf):
    # rows quarantined earlier, judged again by frames without blur_metric: those
    # whose only failure was its value have the batch's schema-level rule instead
    p = _p(spark, sf)
    known = F.filter("failed_rules", lambda r: r["column"] != "blur_metric")
    less = _without_blur(spark, sf)
    out = qa.row_rules_fallback(p.quarantined.withColumn("failed_rules", known),
                                qa.batch_alerts(less.batch_plan, less.violations))
    return out.select("feed_id", "batch_round", "seq", "frame_id", _checks(with_column=True).alias("rules"))


@query("missing_column")
def q_missing_column(spark, sf):
    # A missing column quarantines no row; every batch has an alert
    p = _without_blur(spark, sf)
    alerts = qa.batch_alerts(p.batch_plan, p.violations)
    return (p.batch_plan.select("feed_id", "batch_round", "status", "valid_count", "quarantined_count")
            .join(alerts, ["feed_id", "batch_round"])
            .select("feed_id", "batch_round", "status", "valid_count", "quarantined_count",
                    _checks(with_column=True).alias("rules")))


@query("unreadable_column")
def q_unreadable_column(spark, sf):
    # V1: embeddings that came as text cannot be read: status error
    f = S.frames_table(spark, sf).withColumn("embedding", F.col("embedding").cast("string"))
    p = GatePipeline(spark, f, CFG)
    return p.batch_plan.select("feed_id", "batch_round", "camera_id", "status", "valid_count", "quarantined_count")


@query("split_by_semi_anti")
def q_split_by_semi_anti(spark, sf):
    kept, dropped = qa.split_by_semi_anti(_p(spark, sf).gated)
    return (kept.select("seq", "feed_id", "batch_round", F.lit(True).alias("kept"))
            .unionByName(dropped.select("seq", "feed_id", "batch_round", F.lit(False).alias("kept"))))


@query("failed_rows_distinct")
def q_failed_rows_distinct(spark, sf):
    return qa.failed_rows_distinct(_p(spark, sf).gated)


@query("union_batches")
def q_union_batches(spark, sf):
    v = _p(spark, sf).valid.select("feed_id", "batch_round", "seq")
    return v.where("batch_round <= 15").unionByName(v.where("batch_round > 15"))


@query("frame_id_format")
def q_frame_id_format(spark, sf):
    f = S.frames_table(spark, sf)
    fid = fmt_frame_id(F.col("feed_id"), F.col("batch_round"), F.col("seq"))
    return f.select("seq", fid.alias("formatted_frame_id"), (fid == F.col("frame_id")).alias("same_as_source"))


@query("time_strings")
def q_time_strings(spark, sf):
    f = S.frames_table(spark, sf)
    return f.select("seq", iso_utc(F.col("event_ts")).alias("iso_time"),
                    compact_utc(F.col("event_ts")).alias("compact_time"))


@query("rate_text")
def q_rate_text(spark, sf):
    b = _p(spark, sf).batch_plan
    return b.select("feed_id", "batch_round", percent_text(F.col("quarantine_rate")).alias("rate_percent"),
                    round4(F.col("quarantine_rate")).alias("rate_rounded"))


# ---------------------------------------------------------------------------
# Breaker (W1, W5..W7, I1)
# ---------------------------------------------------------------------------
@query("rolling_quarantine_rate")
def q_rolling_quarantine_rate(spark, sf):
    r = breaker.rolling_quarantine_rate(qa.breaker_input(_p(spark, sf).batch_plan, CFG), CFG)
    return r.select("camera_id", "feed_id", "batch_round",
                    F.round("rolling_quarantine_rate", 9).alias("rolling_quarantine_rate"))



# ---------------------------------------------------------------------------
# Drift (S7, A7, W2..W4, K1..K11, A11, O2)
# ---------------------------------------------------------------------------
from ..functions.ks import large_sample_pvalue_expr  # noqa: E402

_RKEYS = ["feed_id", "batch_round", "camera_id"]


@query("baseline_rows")
def q_baseline_rows(spark, sf):
    return _p(spark, sf).baseline.select("seq", "feed_id", "batch_round", "brightness_avg", "blur_metric")


@query("baseline_centroid")
def q_baseline_centroid(spark, sf):
    b = _p(spark, sf).baseline.select(F.posexplode("embedding").alias("pos", "x"))
    return b.groupBy("pos").agg(F.round(F.avg("x"), 9).alias("centroid_value"))


@query("embedding_norm")
def q_embedding_norm(spark, sf):
    return _p(spark, sf).valid.select("seq", "feed_id", "batch_round", drift.norm_expr("embedding").alias("embedding_norm"))


@query("drift_buffer")
def q_drift_buffer(spark, sf):
    return drift.drift_buffer(_p(spark, sf).batch_plan, CFG).select(*_RKEYS, "buffer_total")


@query("drift_status")
def q_drift_status(spark, sf):
    return drift.drift_status(_p(spark, sf).batches, CFG).select(
        *_RKEYS, "status", "reason", F.col("buffer_size").cast("double").alias("buffer_size"))


@query("drift_windows")
def q_drift_windows(spark, sf):
    p = _p(spark, sf)
    w = drift.drift_windows(p.valid, p.batches, p.baseline_model, CFG).where(F.size("win") >= CFG.drift_window)
    seqs = F.transform("win", lambda e: e["seq"])
    return w.select(*_RKEYS, F.size("win").alias("window_size"),
                    F.array_min(seqs).alias("first_seq"), F.array_max(seqs).alias("last_seq"),
                    F.aggregate(seqs, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("seq_sum"))


def _features(spark, sf):
    return drift.drift_features(_p(spark, sf).drift_plan)


@query("ks_statistic")
def q_ks_statistic(spark, sf):
    return _features(spark, sf).select(*_RKEYS, "feature", "ks_num", "ks_statistic")


@query("ks_pvalue")
def q_ks_pvalue(spark, sf):
    return _features(spark, sf).select(*_RKEYS, "feature", "ks_num", F.round("p_value", 10).alias("p_value"))


@query("ks_pvalue_asymptotic")
def q_ks_pvalue_asymptotic(spark, sf):
    f = _features(spark, sf)
    return f.select(*_RKEYS, "feature", F.round(large_sample_pvalue_expr(), 8).alias("p_value"))


@query("feature_drift")
def q_feature_drift(spark, sf):
    return _features(spark, sf).select(*_RKEYS, "feature", "drift_detected")


@query("centroid_similarity")
def q_centroid_similarity(spark, sf):
    r = _p(spark, sf).drift_plan.where(F.col("status") == "analyzed")
    return r.select(*_RKEYS, F.round("mean_cosine_similarity", 9).alias("mean_cosine_similarity"))


@query("centroid_distance")
def q_centroid_distance(spark, sf):
    r = _p(spark, sf).drift_plan.where(F.col("status") == "analyzed")
    return r.select(*_RKEYS, F.round("mean_euclidean_distance", 9).alias("mean_euclidean_distance"))


@query("drift_reports")
def q_drift_reports(spark, sf):
    r = _p(spark, sf).drift_plan
    return r.select(*_RKEYS, "status", "reason", F.col("buffer_size").cast("double").alias("buffer_size"),
                    F.col("window_size").cast("double").alias("window_size"), "drift_detected",
                    *[F.coalesce(f"{f}_drift", F.lit(False)).alias(f"{f}_drift")
                      for f in ("brightness_avg", "blur_metric", "embedding")],
                    "brightness_avg_ks", "blur_metric_ks", "embedding_ks",
                    *[F.round(f"{f}_p", 10).alias(f"{f}_p") for f in ("brightness_avg", "blur_metric", "embedding")],
                    _features_text(F.col("features")).alias("features"))


def _features_text(features: Column) -> Column:
    """The map of features as text: name, flag, and whether it has centroid metrics."""
    parts = F.transform(F.map_entries(features), lambda e: F.concat_ws(
        ":", e["key"], e["value"]["drift_detected"].cast("string"), e["value"]["mean_cosine_similarity"].isNotNull().cast("string"),
        F.format_string("%.4f", F.round(e["value"]["ks_statistic"], 4))))
    return F.array_join(F.array_sort(parts), "|")


@query("drift_alerts")
def q_drift_alerts(spark, sf):
    a = drift.drift_alerts(_p(spark, sf).drift_plan)
    return a.select(*_RKEYS, "feature", F.round("p_value", 10).alias("p_value"))


@query("drifted_features")
def q_drifted_features(spark, sf):
    r = _p(spark, sf).drift_plan.where((F.col("status") == "analyzed") & F.col("drift_detected"))
    r = r.withColumnRenamed("status", "drift_status")
    feats = breaker.drifted_features_expr(r)
    return r.select(*_RKEYS, F.array_join(feats, ", ").alias("features"),
                    F.size(feats).alias("feature_count"))


@query("tail_per_camera")
def q_tail_per_camera(spark, sf):
    p = _p(spark, sf)
    return drift.tail_per_camera(p.valid, p.batches, CFG)


# ---------------------------------------------------------------------------
# Breaker with drift (J1, I1, W5..W7) and incidents (I2..I7, A8..A10), A5
# ---------------------------------------------------------------------------
from ..operators import incidents as INC  # noqa: E402
from ..operators import summary as SUM  # noqa: E402

_BKEYS = ["camera_id", "feed_id", "batch_round"]


def _types(col: str = "reasons") -> Column:
    return F.array_join(F.transform(col, lambda r: r["type"]), ",")


@query("qa_with_drift")
def q_qa_with_drift(spark, sf):
    ev = _p(spark, sf).evaluated
    return ev.select(*_BKEYS, "valid_count", "quarantined_count", "drift_status",
                     F.coalesce("drift_detected", F.lit(False)).alias("drift_detected"))


@query("breaker_evaluation")
def q_breaker_evaluation(spark, sf):
    ev = _p(spark, sf).evaluated
    return ev.select(*_BKEYS, F.round("rolling_quarantine_rate", 9).alias("rolling_quarantine_rate"),
                     "should_trip", _types().alias("reason_types"),
                     F.array_join(F.transform("reasons", lambda r: r["message"]), "; ").alias("messages"))


@query("breaker_trips")
def q_breaker_trips(spark, sf):
    return flagship(spark, sf)


@query("breaker_suppressed")
def q_breaker_suppressed(spark, sf):
    ev = breaker.breaker_suppressed(_p(spark, sf).evaluated)
    return ev.select(*_BKEYS, F.col("trip_ordinal").cast("int").alias("trip_ordinal"), _types().alias("reason_types"))


@query("breaker_timeline")
def q_breaker_timeline(spark, sf):
    return _p(spark, sf).evaluated.select(*_BKEYS, "breaker_state")


def _incs(spark, sf):
    return _p(spark, sf).incidents


@query("incidents")
def q_incidents(spark, sf):
    i = _incs(spark, sf)
    return i.select("incident_id", "camera_id", "batch_round", "severity", "status", "timestamp", "summary",
                    F.col("metrics.rolling_quarantine_rate").alias("rolling_quarantine_rate"),
                    F.col("metrics.qa_window_batches").alias("qa_window_batches"),
                    F.col("drift_report").isNotNull().alias("has_drift_report"),
                    F.col("drift_report.window_size").cast("double").alias("drift_window_size"),
                    _features_text(F.col("drift_report.features")).alias("drift_features"))


@query("incident_notifications")
def q_incident_notifications(spark, sf):
    n = INC.incident_payloads(_incs(spark, sf), CFG)
    return n.select("incident_id", F.col("notification_channels.chat.channel").alias("channel"),
                    F.col("notification_channels.chat.text").alias("chat_text"),
                    F.col("notification_channels.pager.routing_key").alias("routing_key"),
                    F.col("notification_channels.pager.payload.summary").alias("pager_summary"))


@query("retrain_requests")
def q_retrain_requests(spark, sf):
    r = INC.retrain_requests(_incs(spark, sf), CFG)
    return r.select("request_id", "incident_id", "camera_id", "triggered_at", "pipeline", "engine", "action",
                    "dag_id", F.col("metadata.batch_round").alias("batch_round"),
                    F.size("inputs.reasons").alias("reason_count"))


@query("incident_records")
def q_incident_records(spark, sf):
    r = INC.incident_records(_incs(spark, sf), CFG)
    return r.select("incident_id", "camera_id", "batch_round", "alert_path",
                    F.col("retraining.request_id").alias("request_id"),
                    F.col("retraining.status").alias("retraining_status"),
                    F.size("reasons").alias("reason_count"))


@query("round_incidents")
def q_round_incidents(spark, sf):
    r = INC.round_incidents(_incs(spark, sf))
    return r.select("batch_round", "incident_count", F.array_join("incident_ids", ",").alias("incident_ids"))


@query("incident_summary")
def q_incident_summary(spark, sf):
    s = INC.incident_summary(_incs(spark, sf))
    return s.select("total_incidents", F.array_join("tripped_cameras", ",").alias("tripped_cameras"))


@query("incident_triggers")
def q_incident_triggers(spark, sf):
    return INC.incident_triggers(_incs(spark, sf))


@query("batch_frame_ids")
def q_batch_frame_ids(spark, sf):
    return SUM.batch_frame_ids(_p(spark, sf).valid)


@query("pipeline_totals")
def q_pipeline_totals(spark, sf):
    p = _p(spark, sf)
    return SUM.pipeline_totals(p.batches, p.drift_reports, p.incidents)


@query("batch_telemetry")
def q_batch_telemetry(spark, sf):
    p = _p(spark, sf)
    t = SUM.batch_telemetry(p.valid, p.batch_plan)
    return t.select("feed_id", "batch_round", "camera_id", "frame_count",
                    F.col("first_seq").cast("double").alias("first_seq"),
                    F.col("last_seq").cast("double").alias("last_seq"),
                    *[F.round(c, 9).alias(c) for c in ("brightness_avg_mean", "brightness_avg_min",
                                                       "blur_metric_mean", "embedding_mean", "embedding_std")])


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: first trips of the latched breaker (rate + drift reasons)."""
    ev = breaker.breaker_trips(_p(spark, sf).evaluated)
    return ev.select(*_BKEYS, F.round("rolling_quarantine_rate", 9).alias("rolling_quarantine_rate"),
                     _types().alias("reason_types"))
