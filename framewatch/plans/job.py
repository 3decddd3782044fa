"""E1 as a batch job: frames -> every output table, written once.

The gated rows are written once, by validity and round, and everything else
reads that table: the raw frames are read once, and quarantined rows, windows
and telemetry read only their own part of it.

    <out>/gated               F9   parquet, by validity and round
    <out>/quarantine_rows     S8   parquet, partitioned by round and feed
    <out>/quarantine_reasons  S9   JSON lines, partitioned by round and feed
    <out>/schema_alerts       M24  parquet
    <out>/qa_batches          A2   parquet
    <out>/batch_telemetry     A5   parquet (its frame ids: gated, is_valid=true)
    <out>/drift_reports       K10  parquet
    <out>/breaker             I1/W5..W7 parquet
    <out>/incidents           S10  JSON, idempotent by incident_id
    <out>/retrain_requests    S11  JSON, idempotent by request_id
    <out>/pipeline_totals     A9   parquet

Usage: python -m framewatch.plans.job <frames.parquet> <out_dir> <baseline rounds> [camera ids... | topology=<folder>]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_CONFIG, GateConfig
from ..operators import incidents as INC
from ..operators import qa, summary
from ..sources import sinks
from ..sources.frames import read_frames
from .pipeline import GatePipeline


def run_batch_job(spark: SparkSession, frames: DataFrame, out: str,
                  cfg: GateConfig = DEFAULT_CONFIG, baseline: DataFrame | None = None) -> dict[str, str]:
    """Write every table; the reference period is ``baseline`` or
    ``cfg.baseline_rounds``.  Returns the paths by table."""
    out = out.rstrip("/")
    paths = {}

    def put(name: str, df: DataFrame, by: tuple[str, ...] = ()) -> None:
        paths[name] = f"{out}/{name}"
        df.write.mode("overwrite").partitionBy(*by).parquet(paths[name])

    rows = qa.gate(frames, cfg)
    put("gated", rows, ("is_valid", "batch_round"))
    gated = spark.read.schema(rows.schema).parquet(paths["gated"]).select(*rows.columns)
    p = GatePipeline(spark, frames, cfg, baseline=baseline, gated=gated)
    try:
        batches, reports, evaluated, incs = p.batches, p.drift_reports, p.evaluated, p.incidents
        paths["quarantine_rows"] = f"{out}/quarantine_rows"
        sinks.write_quarantine_rows(p.quarantined, paths["quarantine_rows"])
        paths["quarantine_reasons"] = f"{out}/quarantine_reasons"
        sinks.write_quarantine_reasons(qa.quarantine_reasons(p.gated, batches, p.violations), paths["quarantine_reasons"])
        put("schema_alerts", qa.batch_alerts(batches, p.violations))
        put("qa_batches", batches)
        put("batch_telemetry", summary.batch_telemetry(p.valid, batches))
        put("drift_reports", reports)
        put("breaker", evaluated)
        paths["incidents"] = f"{out}/incidents"
        sinks.write_incidents(INC.incident_payloads(incs, cfg).drop("rolling_quarantine_rate"), paths["incidents"])
        paths["retrain_requests"] = f"{out}/retrain_requests"
        sinks.write_retrain_requests(INC.retrain_requests(incs, cfg), paths["retrain_requests"])
        put("pipeline_totals", summary.pipeline_totals(batches, reports, incs))
    finally:
        p.close()
    return paths


def main(argv: list[str]) -> None:
    from ..session import get_spark
    frames_path, out, rounds = argv[0], argv[1], int(argv[2])
    cfg = DEFAULT_CONFIG.with_(baseline_rounds=rounds)
    if len(argv) > 3 and argv[3].startswith("topology="):
        cfg = cfg.with_(topology=argv[3].removeprefix("topology="))
    elif len(argv) > 3:
        cfg = cfg.with_(known_cameras=tuple(argv[3:]))
    spark = get_spark(app="framewatch-job")
    run_batch_job(spark, read_frames(spark, frames_path), out, cfg)


if __name__ == "__main__":
    main(sys.argv[1:])
