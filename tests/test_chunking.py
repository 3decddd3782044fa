"""Chunked prefix sums and halo frames give the same answers as one chunk.

Tiny chunks force every camera to be cut into many pieces (the layout a hot
camera gets at scale), so offsets and halos are exercised on every boundary.
"""
from conftest import SF_SMALL
from framewatch.config import FIXTURE_CONFIG
from framewatch.operators import breaker, drift
from framewatch.plans.pipeline import GatePipeline

TINY = FIXTURE_CONFIG.with_(chunk_rounds=2, chunk_positions=23, chunk_records=5)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_tiny_chunks_equal_default(spark):
    p = GatePipeline.from_sf(spark, SF_SMALL)
    q = GatePipeline(spark, p.frames, TINY)
    cols = ["feed_id", "batch_round", "camera_id", "buffer_total"]
    assert _rows(drift.drift_buffer(q.batches, TINY), cols) == _rows(drift.drift_buffer(p.batches, FIXTURE_CONFIG), cols)
    rcols = ["feed_id", "batch_round", "camera_id", "status", "buffer_size", "window_size",
             "brightness_avg_ks", "blur_metric_ks", "embedding_ks", "embedding_p", "mean_euclidean_distance"]
    assert _rows(q.drift_reports, rcols) == _rows(p.drift_reports, rcols)
    bcols = ["camera_id", "feed_id", "batch_round", "rolling_quarantine_rate", "trip_ordinal", "breaker_state"]
    assert _rows(q.evaluated, bcols) == _rows(p.evaluated, bcols)
    tcols = ["camera_id", "seq", "rank_from_end"]
    assert _rows(drift.tail_per_camera(q.valid, q.batches, TINY), tcols) == \
        _rows(drift.tail_per_camera(p.valid, p.batches, FIXTURE_CONFIG), tcols)
