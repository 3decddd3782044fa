"""Incident, notification and retraining-request tables (I2..I7, A8, A10).

All are projections of the breaker's first-trip rows (≤ one per camera), so
they are tiny; ids are deterministic hashes so a replay rewrites the same
records (idempotent sinks) instead of minting new random ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import GateConfig
from ..functions.text import percent_text, round4, stable_id
from .breaker import breaker_trips


def incident_id_expr() -> Column:
    return F.concat(F.lit("inc_"), F.col("camera_id"), F.lit("_"),
                    stable_id(F.col("camera_id"), F.col("batch_round")))


def request_id_expr() -> Column:
    return F.concat(F.lit("retrain_"), stable_id(F.lit("retrain"), F.col("incident_id")))


def summary_expr() -> Column:
    """I4: prefix + reason messages joined by '; '."""
    prefix = F.format_string(C.SUMMARY_PREFIX.replace("{camera}", "%s"), F.col("camera_id"))
    return F.concat(prefix, F.array_join(F.transform("reasons", lambda r: r["message"]), "; "))


def incidents(evaluated: DataFrame, batches: DataFrame, reports: DataFrame | None,
              cfg: GateConfig) -> DataFrame:
    """I2 + I3: one incident per first trip, with the drift summary only when
    the report was analyzed.  Time = last event time of the tripping batch."""
    trips = breaker_trips(evaluated)
    times = batches.select("feed_id", "batch_round",
                           F.concat(F.col("last_timestamp"), F.lit("+00:00")).alias("timestamp"))
    out = trips.join(times, ["feed_id", "batch_round"], "left")
    if reports is not None and "drift_status" in out.columns:
        drift_summary = F.when(F.col("drift_status") == "analyzed", F.struct(
            F.col("drift_detected").alias("drift_detected"),
            F.col("drift_window_size").alias("window_size"),
            F.col("drift_features").alias("features")))
    else:
        drift_summary = F.lit(None)
    return out.select(
        incident_id_expr().alias("incident_id"),
        F.lit(cfg.severity).alias("severity"),
        F.lit("open").alias("status"),
        "timestamp", "batch_round", "camera_id", "feed_id",
        F.lit(True).alias("circuit_breaker_tripped"),
        summary_expr().alias("summary"),
        "reasons",
        F.struct(round4(F.col("rolling_quarantine_rate")).alias("rolling_quarantine_rate"),
                 F.lit(cfg.qa_window_batches).alias("qa_window_batches")).alias("metrics"),
        drift_summary.alias("drift_report"),
        F.col("rolling_quarantine_rate"))


def notifications_expr(cfg: GateConfig) -> Column:
    """Chat and pager blocks; names come from the configuration."""
    chat = F.struct(
        F.lit(cfg.alert_channel).alias("channel"),
        F.format_string("%s: breaker open for %s since round %d, %s of recent rows quarantined",
                        F.lit(cfg.incident_title), F.col("camera_id"), F.col("batch_round"),
                        percent_text(F.col("rolling_quarantine_rate"))).alias("text"))
    pager = F.struct(
        F.lit(cfg.pager_routing_key).alias("routing_key"),
        F.lit("trigger").alias("event_action"),
        F.struct(
            F.format_string("Breaker open for %s", F.col("camera_id")).alias("summary"),
            F.lit(cfg.severity).alias("severity"),
            F.lit(cfg.source_name).alias("source"),
            F.struct("camera_id", "batch_round", "reasons").alias("custom_details")).alias("payload"))
    return F.struct(chat.alias("chat"), pager.alias("pager"))


def incident_payloads(incs: DataFrame, cfg: GateConfig) -> DataFrame:
    """Full nested payload (what the alert sink writes as JSON)."""
    return incs.withColumn("notification_channels", notifications_expr(cfg))


def retrain_requests(incs: DataFrame, cfg: GateConfig) -> DataFrame:
    """A retraining request per incident."""
    return incs.select(
        request_id_expr().alias("request_id"),
        F.lit(cfg.source_name).alias("trigger_source"),
        F.col("timestamp").alias("triggered_at"),
        "incident_id", "camera_id",
        F.lit(cfg.retrain_pipeline).alias("pipeline"),
        F.lit(cfg.retrain_engine).alias("engine"),
        F.lit(cfg.retrain_action).alias("action"),
        F.lit(cfg.retrain_dag_id).alias("dag_id"),
        F.struct(F.lit(cfg.quarantine_dir).alias("quarantine_dir"),
                 F.lit(cfg.alerts_dir).alias("alerts_dir"), "reasons").alias("inputs"),
        F.struct("batch_round", "severity").alias("metadata"))


def incident_records(incs: DataFrame, cfg: GateConfig) -> DataFrame:
    """The orchestrator's record of an incident: alert path, queued
    retraining hand-off (the request table is the hand-off, no network call)."""
    return incs.select(
        "incident_id", "camera_id", "batch_round",
        F.concat(F.lit(cfg.alerts_dir), F.lit("/"), F.col("incident_id"), F.lit(".json")).alias("alert_path"),
        F.struct(request_id_expr().alias("request_id"), F.lit("queued").alias("status")).alias("retraining"),
        "reasons")


def round_incidents(incs: DataFrame) -> DataFrame:
    """Incidents per round (≤ one per camera, so the list is bounded by
    the configured camera count)."""
    return incs.groupBy("batch_round").agg(
        F.count(F.lit(1)).alias("incident_count"),
        F.array_sort(F.collect_list("incident_id")).alias("incident_ids"))


def incident_summary(incs: DataFrame) -> DataFrame:
    """A10: totals and tripped cameras (bounded by the camera whitelist)."""
    return incs.agg(
        F.count(F.lit(1)).alias("total_incidents"),
        F.array_sort(F.collect_set("camera_id")).alias("tripped_cameras"))


def incident_triggers(incs: DataFrame) -> DataFrame:
    """A10: the incidents and triggers of the summary as rows, one per reason."""
    return incs.select("incident_id", "camera_id", "batch_round", F.posexplode("reasons").alias("place", "r")).select(
        "incident_id", "camera_id", "batch_round", "place", F.col("r.type").alias("type"), F.col("r.message").alias("message"))
