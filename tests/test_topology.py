"""The topology as a table: the same answers as a configured list, pruning, and size."""
import time

import pytest

from conftest import SF_SMALL
from framewatch.config import FIXTURE_CONFIG
from framewatch.operators import breaker, drift
from framewatch.plans.pipeline import GatePipeline
from framewatch.sources import topology
from framewatch.sources.frames import accepted_feeds, feed_subset, unknown_feeds
from test_plans import plan

LISTED = FIXTURE_CONFIG.with_(known_cameras=("camera_9", "camera_2", "camera_5", "camera_11"))
BATCH = "feed_id string, batch_round int, camera_id string, status string, valid_count bigint, quarantined_count bigint"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    def write(rows):
        path = str(tmp_path_factory.mktemp("topology") / "t")
        topology.write_topology(spark.createDataFrame(rows, topology.TOPOLOGY_SCHEMA), path)
        return FIXTURE_CONFIG.with_(topology=path)
    return write


@pytest.fixture(scope="module")
def tabled(table):
    places = [(c, 10 * k) for k, c in enumerate(LISTED.known_cameras)]
    # retired, repeated and missing cameras change nothing
    return table([*places, ("camera_2", 99), ("camera_1", -1), (None, 3)])


@pytest.fixture(scope="module")
def p(spark):
    return GatePipeline.from_sf(spark, SF_SMALL)


@pytest.fixture(scope="module")
def batches(spark):
    """Cameras with two feeds a round, an unknown camera, a null one."""
    rows = []
    for r in range(1, 30):
        for feed, cam in (("camera_9", "camera_9"), ("camera_2", "camera_9"), ("x", "camera_9"), ("camera_5", "camera_5"), ("z", "nobody"), ("n", None)):
            bad = (r * len(feed)) % 5
            rows.append((feed, r, cam, "passed", 10 - bad, bad))
    return spark.createDataFrame(rows, BATCH)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_table_and_list_agree(p, batches, tabled):
    for f in (accepted_feeds, unknown_feeds):
        assert _rows(f(p.frames, tabled).select("feed_id", "seq")) == _rows(f(p.frames, LISTED).select("feed_id", "seq")) != []
    for f in (drift.drift_status, breaker.breaker_evaluation):
        found = _rows(f(batches, tabled))
        assert found == _rows(f(batches, LISTED)) and found


def test_unknown_has_null_ids_and_an_empty_table_knows_nothing(batches, table, tabled):
    lost = topology.unknown_rows(batches, "camera_id", tabled).select("camera_id").distinct().collect()
    assert {r[0] for r in lost} == {"nobody", None}
    none = table([])
    assert topology.known_rows(batches, "camera_id", none).count() == 0
    assert breaker.breaker_evaluation(batches, none).count() == 0
    assert {r["status"] for r in drift.drift_status(batches, none).collect()} == {"skipped"}
    assert not topology.with_known(batches, "camera_id", none, "k").where("k").count()


def test_cameras_prune_the_stored_feeds(spark, p, tabled):
    for df in (accepted_feeds(p.frames, tabled), feed_subset(
            p.frames, topology.cameras_in_use(spark, tabled).withColumnRenamed("_camera", "feed_id"))):
        df = df.select("feed_id", "seq", "brightness_avg")
        t = plan(df)
        scan = [line for line in t.splitlines() if "FileScan" in line and "brightness_avg" in line]
        assert len(scan) == 1 and "dynamicpruningexpression" in scan[0] and "SortMergeJoin" not in t
        assert {r[0] for r in df.select("feed_id").distinct().collect()} == set(LISTED.known_cameras)


def test_a_hundred_thousand_cameras_plan_in_seconds(spark, batches, table):
    cfg = table([(f"camera_{k}", k) for k in range(100_000)])
    start = time.monotonic()
    for df in (breaker.breaker_evaluation(batches, cfg), drift.drift_status(batches, cfg)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert len(text) < 200_000 and "camera_77777" not in text
    assert time.monotonic() - start < 30
    assert breaker.breaker_evaluation(batches, cfg).select("camera_id").distinct().count() == 2


def test_a_stream_with_a_table_equals_the_batch(spark, p, tabled, tmp_path):
    from framewatch.sources.frames import FRAME_SCHEMA, stream_frames
    from framewatch.streaming.gate import StatefulGate
    src = str(tmp_path / "in")
    p.frames.where("batch_round <= 12").select(*FRAME_SCHEMA.names).repartition(1).write.parquet(src)
    gate = StatefulGate(tabled, p.baseline_model, str(tmp_path / "out"))
    q = gate.start(stream_frames(spark, src), str(tmp_path / "ckpt"))
    assert q.awaitTermination(120) and q.exception() is None
    early = p.batches.where("batch_round <= 12")
    own = ["feed_id", "batch_round", "camera_id", "status", "valid_count", "buffer_size"]
    reports = gate.read(spark, "drift_reports").select(*own)
    assert _rows(reports) == _rows(drift.drift_status(early, tabled).select(*own)) != []
