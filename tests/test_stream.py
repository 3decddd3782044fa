"""Streaming variant == batch pipeline (W8, W9), and sink round trips."""
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, frame
from framewatch.config import FIXTURE_CONFIG
from framewatch.operators import incidents, qa, summary
from framewatch.plans.pipeline import GatePipeline
from framewatch.sources import sinks
from framewatch.sources.frames import FRAME_SCHEMA, stream_frames
from framewatch.streaming.gate import StatefulGate, start_gate_sinks

CMP = ["feed_id", "batch_round", "camera_id", "status", "buffer_size", "window_size",
       "brightness_avg_ks", "blur_metric_ks", "embedding_ks", "brightness_avg_p", "embedding_p"]


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _whole(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


def _round_files(spark, frames, root, rounds_per_file=1):
    """Write frames as one parquet file per group of rounds, oldest first."""
    rounds = sorted(r[0] for r in frames.select("batch_round").distinct().collect())
    groups = [rounds[i:i + rounds_per_file] for i in range(0, len(rounds), rounds_per_file)]
    t0 = time.time() - 10_000
    for k, g in enumerate(groups):
        d = os.path.join(root, f"g{k:03d}")
        frames.where(F.col("batch_round").isin(g)).select(*FRAME_SCHEMA.fieldNames()) \
            .coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            os.utime(os.path.join(d, f), (t0 + k, t0 + k))
    return len(groups)


def _equal_to_batch(spark, gate, p):
    assert _rows(gate.read(spark, "qa_batches"), ["feed_id", "batch_round", "camera_id", "status", "valid_count", "last_timestamp"]) == \
        _rows(p.batches, ["feed_id", "batch_round", "camera_id", "status", "valid_count", "last_timestamp"])
    assert _rows(gate.read(spark, "drift_reports"), CMP) == _rows(p.drift_reports, CMP)
    cols = ["camera_id", "feed_id", "batch_round", "trip_ordinal", "breaker_state", "rolling_quarantine_rate"]
    assert _rows(gate.read(spark, "breaker"), cols) == _rows(p.evaluated, cols)
    icols = ["incident_id", "camera_id", "batch_round", "summary", "timestamp"]
    assert _rows(gate.read(spark, "incidents"), icols) == _rows(p.incidents, icols)
    rcols = ["request_id", "incident_id", "triggered_at"]
    assert _rows(gate.read(spark, "retrain_requests"), rcols) == _rows(incidents.retrain_requests(p.incidents, FIXTURE_CONFIG), rcols)
    assert _rows(gate.totals(spark), ["metric", "value"]) == _rows(
        summary.pipeline_totals(p.batches, p.drift_reports, p.incidents), ["metric", "value"])


def _run(gate, spark, src, work):
    q = gate.start(stream_frames(spark, os.path.join(src, "g*"), max_files_per_trigger=1), os.path.join(work, "ckpt"))
    q.awaitTermination(600)
    assert q.exception() is None
    return q


def test_stream_equals_batch_across_a_restart(spark):
    """Whole batches per micro-batch; the query stops half-way and goes on from its checkpoint."""
    p = GatePipeline.from_sf(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="fw-stream-")
    src, later = os.path.join(work, "src"), os.path.join(work, "later")
    n = _round_files(spark, p.frames, src, rounds_per_file=8)
    os.makedirs(later)
    for k in range(n // 2, n):
        os.rename(os.path.join(src, f"g{k:03d}"), os.path.join(later, f"g{k:03d}"))
    gate = StatefulGate(FIXTURE_CONFIG, p.baseline_model, os.path.join(work, "out"))
    first = _run(gate, spark, src, work)
    half = gate.read(spark, "qa_batches").count()
    assert 0 < half < p.batches.count() and first.lastProgress["batchId"] >= 1
    for k in range(n // 2, n):
        os.rename(os.path.join(later, f"g{k:03d}"), os.path.join(src, f"g{k:03d}"))
    gate = StatefulGate(FIXTURE_CONFIG, p.baseline_model, os.path.join(work, "out"))
    second = _run(gate, spark, src, work)
    assert second.lastProgress["batchId"] > first.lastProgress["batchId"]
    _equal_to_batch(spark, gate, p)
    # the state store holds what is bounded, per key: no folder of ours
    assert sorted(os.listdir(os.path.join(work, "out"))) == ["evaluated"]


def test_batches_in_pieces_give_the_batch_result(spark, make_frames):
    """Rows of a batch, and whole rounds, arrive in any micro-batch: partials are held until
    a batch is complete, and rounds of a feed leave in order."""
    import random
    cfg = FIXTURE_CONFIG.with_(embedding_dim=8, known_cameras=("camera_1", "camera_2"), drift_window=6)
    draw, rows = random.Random(4), []
    for rnd in range(1, 9):
        for feed in ("camera_1", "camera_2"):
            for _ in range(4):
                low = feed == "camera_2" and rnd > 4
                rows.append(frame(len(rows), feed=feed, rnd=rnd, b=draw.choice([5.0, 60.0]) if low else draw.gauss(165, 10), blur=draw.random(),
                                  emb=[draw.gauss(0, 1) for _ in range(8)], ts=f"2026-05-26T12:{rnd:02d}:{draw.randrange(60):02d}+00:00"))
    p = GatePipeline(spark, make_frames(rows), cfg, baseline=make_frames(rows[:40]))
    draw.shuffle(rows)
    work = tempfile.mkdtemp(prefix="fw-pieces-")
    src, t0 = os.path.join(work, "src"), time.time() - 10_000
    for k in range(4):
        d = os.path.join(src, f"g{k:03d}")
        make_frames(rows[16 * k:16 * k + 16]).coalesce(1).write.parquet(d)
        for f in os.listdir(d):
            os.utime(os.path.join(d, f), (t0 + k, t0 + k))
    gate = StatefulGate(cfg, p.baseline_model, os.path.join(work, "out"), frames_per_batch=4)
    _run(gate, spark, src, work)
    assert p.incidents.count() == 1
    got, want = gate.read(spark, "breaker"), p.evaluated
    cols = ["camera_id", "feed_id", "batch_round", "trip_ordinal", "breaker_state", "rolling_quarantine_rate"]
    assert _rows(got, cols) == _rows(want, cols)
    assert _rows(gate.read(spark, "drift_reports"), CMP) == _rows(p.drift_reports, CMP)
    assert _rows(gate.read(spark, "incidents"), ["incident_id", "summary"]) == _rows(p.incidents, ["incident_id", "summary"])


def test_gate_stream_sinks(spark):
    p = GatePipeline.from_sf(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="fw-gate-")
    src = os.path.join(work, "src")
    _round_files(spark, p.frames, src, rounds_per_file=10)
    stream = spark.readStream.schema(FRAME_SCHEMA).parquet(os.path.join(src, "g*"))
    q = start_gate_sinks(stream, FIXTURE_CONFIG, os.path.join(work, "valid"),
                         os.path.join(work, "quar"), os.path.join(work, "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    keys = ["feed_id", "batch_round", "seq"]
    assert _rows(spark.read.parquet(os.path.join(work, "valid")), keys) == _rows(p.valid, keys)
    assert _rows(spark.read.parquet(os.path.join(work, "quar")), keys) == _rows(p.quarantined, keys)


def test_sinks_round_trip_and_idempotent(spark):
    p = GatePipeline.from_sf(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="fw-sink-")
    odd = p.quarantined.withColumn("camera_id", F.when(F.col("seq") % 3 == 0, "007").when(F.col("seq") % 3 == 1, "").otherwise(None))
    for rows in (p.quarantined, odd):
        for _ in range(2):                             # a replay replaces its batches
            sinks.write_quarantine_rows(rows, os.path.join(work, "q"))
        back = sinks.read_quarantine_rows(spark, os.path.join(work, "q"))
        assert _whole(back) == _whole(rows.select(*back.columns))
    reasons = qa.quarantine_reasons(p.gated, p.batches)
    for _ in range(2):
        sinks.write_quarantine_reasons(reasons, os.path.join(work, "r"))
    rb = sinks.read_quarantine_reasons(spark, os.path.join(work, "r"))
    assert _whole(rb) == _whole(reasons.select(*rb.columns))
    payloads = incidents.incident_payloads(p.incidents, FIXTURE_CONFIG).drop("rolling_quarantine_rate")
    path = os.path.join(work, "alerts")
    sinks.write_incidents(payloads, path)
    sinks.write_incidents(payloads, path)              # a replay writes nothing new
    n = spark.read.json(path).count()
    assert n == payloads.count() > 0
    req = incidents.retrain_requests(p.incidents, FIXTURE_CONFIG)
    sinks.write_retrain_requests(req, os.path.join(work, "req"))
    sinks.write_retrain_requests(req, os.path.join(work, "req"))
    assert spark.read.json(os.path.join(work, "req")).count() == req.count()


def test_batch_job_writes_all_tables(spark):
    from framewatch.plans.job import run_batch_job
    p = GatePipeline.from_sf(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="fw-job-")
    paths = run_batch_job(spark, p.frames, out, FIXTURE_CONFIG)
    assert spark.read.parquet(paths["qa_batches"]).count() == p.batches.count()
    assert spark.read.parquet(paths["quarantine_rows"]).count() == p.quarantined.count()
    tot = {r["metric"]: r["value"] for r in spark.read.parquet(paths["pipeline_totals"]).collect()}
    assert tot["total_quarantined_rows"] == p.quarantined.count()
    assert spark.read.json(paths["incidents"]).count() == tot["total_incidents"]
    with pytest.raises(ValueError):                    # no reference period, no silent default
        run_batch_job(spark, p.frames, out + "-2", FIXTURE_CONFIG.with_(baseline_rounds=None))


def test_job_reads_the_raw_frames_once(spark, tmp_path):
    """The gated rows are written once; every other table comes from them."""
    from framewatch.plans.job import run_batch_job
    p = GatePipeline.from_sf(spark, SF_SMALL)
    raw = str(tmp_path / "raw")
    p.frames.select(*FRAME_SCHEMA.names).write.parquet(raw)
    out = str(tmp_path / "out")
    read = spark.read.schema(FRAME_SCHEMA).parquet(raw)
    paths = run_batch_job(spark, read, out, FIXTURE_CONFIG)
    q = GatePipeline(spark, read, FIXTURE_CONFIG, gated=spark.read.schema(
        qa.gate(read, FIXTURE_CONFIG).schema).parquet(paths["gated"]))
    for df in (q.batch_plan, q.quarantined, q.valid):  # the gated table is all that is read
        assert df.count() and all("/out/gated/" in f for f in df.inputFiles())
    assert q.batch_plan.count() == p.batch_plan.count() and q.quarantined.count() == p.quarantined.count()
