"""QA gate operators: split, batch status, alerts and failure counts.

Shuffles: rule evaluation is narrow; the batch table is a hash aggregation
keyed by (feed_id, batch_round, camera_id) with map-side partial aggregation
(a hot batch is combined inside each map task before it is shuffled),
followed by a small second level per (feed_id, batch_round).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import GateConfig
from ..functions.rules import RULES_TYPE, Rule, evaluate_rules, has_unreadable, violation_rules
from ..functions.text import parse_utc, utc_text
from ..sources.topology import known_rows

BATCH_KEYS = ["feed_id", "batch_round"]


def gate(frames: DataFrame, cfg: GateConfig, rules: list[Rule] | None = None) -> DataFrame:
    """Frames with ``failed_rules`` and ``is_valid`` attached."""
    return evaluate_rules(frames, cfg, rules)


def valid_frames(gated: DataFrame) -> DataFrame:
    """F10 valid side (coerced values, rule columns dropped)."""
    return gated.where(F.col("is_valid")).drop("failed_rules", "is_valid")


def quarantined_frames(gated: DataFrame) -> DataFrame:
    """F10 quarantined side: whole rows with every failed rule attached."""
    return gated.where(~F.col("is_valid")).drop("is_valid")


def status_expr(valid: F.Column, quarantined: F.Column, violations: list[dict] = ()) -> F.Column:
    """M7: passed when nothing is quarantined; failed when nothing is valid;
    error when a column of the contract cannot be read at all (V1)."""
    if has_unreadable(violations):
        return F.lit(C.STATUS_ERROR)
    return (F.when(quarantined == 0, F.lit(C.STATUS_PASSED))
             .when(valid == 0, F.lit(C.STATUS_FAILED))
             .otherwise(F.lit(C.STATUS_PARTIAL)))


def rate_expr(valid: F.Column, quarantined: F.Column) -> F.Column:
    """A3: quarantined / total as double, 0.0 for an empty record."""
    total = valid + quarantined
    return F.when(total == 0, F.lit(0.0)).otherwise(quarantined.cast("double") / total)


def qa_batches(gated: DataFrame, violations: list[dict] = ()) -> DataFrame:
    """A2: one row per (feed, round): batch camera, counts, status, rate.

    The batch camera is the ``camera_id`` of the batch's first row (M8), even
    when that id itself fails its rule.

    Two levels so the pass over all frames is a *hash* aggregation: level 1
    groups by (feed, round, camera id) with fixed-width buffers only (first
    seq, counts, last event time as a timestamp); level 2 picks the camera of
    the smallest first-seq over that small result (string ``min_by``)."""
    event_time = parse_utc(F.col("timestamp"))
    l1 = gated.groupBy("feed_id", "batch_round",
                       F.coalesce("camera_id", F.lit("unknown")).alias("camera_id")).agg(
        F.min("seq").alias("_first_seq"),
        F.count_if(F.col("is_valid")).alias("valid_count"),
        F.count_if(~F.col("is_valid")).alias("quarantined_count"),
        F.max(event_time).alias("_last_ts"))
    agg = l1.groupBy(*BATCH_KEYS).agg(
        F.min_by("camera_id", "_first_seq").alias("camera_id"),
        F.sum("valid_count").alias("valid_count"),
        F.sum("quarantined_count").alias("quarantined_count"),
        utc_text(F.max("_last_ts")).alias("last_timestamp"))
    v, q = F.col("valid_count"), F.col("quarantined_count")
    return (agg.withColumn("status", status_expr(v, q, violations))
               .withColumn("total_count", v + q)
               .withColumn("quarantine_rate", rate_expr(v, q)))


def failure_alerts(gated: DataFrame) -> DataFrame:
    """A1: one alert per failing row with its rules (long form keyed by seq).

    Rules of a row are already grouped by the projection, so no shuffle is
    needed; schema-level alerts (null ``seq``) come from ``batch_alerts``.
    """
    return (gated.where(~F.col("is_valid"))
            .select(*BATCH_KEYS, F.col("seq").alias("row_index"), "failed_rules"))


def batch_alerts(batches: DataFrame, violations: list[dict]) -> DataFrame:
    """Schema-level failures attach to every batch with a null row index;
    none if the schema keeps the contract."""
    keys = batches.select(*BATCH_KEYS).where(F.lit(bool(violations)))
    return keys.select(*BATCH_KEYS, F.lit(None).cast("long").alias("row_index"),
                       violation_rules(violations).alias("failed_rules"))


def quarantine_reasons(gated: DataFrame, batches: DataFrame, violations: list[dict] = ()) -> DataFrame:
    """The reason record of every quarantined row; a row without rules of its
    own has those of the schema (M25).

    ``camera_id`` is the row's own id; ``quarantined_at`` is the batch's last
    event time so a replay writes identical records.
    """
    rules = F.when(F.size("failed_rules") > 0, F.col("failed_rules")).otherwise(violation_rules(violations))
    q = gated.where(~F.col("is_valid")).select(
        *BATCH_KEYS, "seq", "camera_id", "frame_id", rules.alias("failed_rules"))
    b = batches.select(*BATCH_KEYS, F.col("last_timestamp").alias("quarantined_at"))
    return q.join(b, BATCH_KEYS, "left").select(
        *BATCH_KEYS, F.col("seq").alias("row_index"), "camera_id", "frame_id",
        "failed_rules", "quarantined_at")


def row_rules_fallback(quarantined: DataFrame, schema_alerts: DataFrame) -> DataFrame:
    """J2 (M25): the rules of a quarantined row (they are on the row); when it
    has none, the schema-level rules of its batch (null row index)."""
    none = F.array().cast(RULES_TYPE)
    sch = (schema_alerts.where(F.col("row_index").isNull())
           .select(*BATCH_KEYS, F.col("failed_rules").alias("_batch_rules")))
    rules = F.when(F.size("failed_rules") > 0, F.col("failed_rules")).otherwise(F.coalesce("_batch_rules", none))
    return quarantined.join(sch, BATCH_KEYS, "left").select(*BATCH_KEYS, "seq", "frame_id", rules.alias("failed_rules"))


def rule_failure_counts(gated: DataFrame, batches: DataFrame) -> DataFrame:
    """A4: failures per (batch camera, round, column, check).

    Pre-aggregated per (feed, round, column, check) before the join with the
    batch table, so the join input is tiny whatever the row count.
    """
    per_batch = (gated.where(~F.col("is_valid"))
                 .select(*BATCH_KEYS, F.explode("failed_rules").alias("r"))
                 .groupBy(*BATCH_KEYS, F.col("r.column").alias("column"),
                          F.col("r.check").alias("check"))
                 .agg(F.count(F.lit(1)).alias("failures")))
    return (per_batch.join(batches.select(*BATCH_KEYS, "camera_id"), BATCH_KEYS)
            .groupBy("camera_id", "batch_round", "column", "check")
            .agg(F.sum("failures").alias("failures")))


def split_by_semi_anti(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep / drop rows by their failed keys via semi and anti joins.
    Equal to the one-pass split; kept for callers that hold a key list."""
    failed = failed_rows_distinct(gated)
    rows = gated.drop("failed_rules", "is_valid")
    keys = BATCH_KEYS + ["seq"]
    return rows.join(failed, keys, "left_anti"), rows.join(failed, keys, "left_semi")


def failed_rows_distinct(gated: DataFrame) -> DataFrame:
    """Distinct failed row keys (one row per failing row)."""
    return (gated.where(~F.col("is_valid")).select(*BATCH_KEYS, "seq")
            .where(F.col("seq").isNotNull()).distinct())


def breaker_input(batches: DataFrame, cfg: GateConfig) -> DataFrame:
    """the slim batch record for the breaker, known cameras only."""
    return (known_rows(batches, "camera_id", cfg)
            .select(*BATCH_KEYS, "camera_id", "status", "valid_count", "quarantined_count"))
