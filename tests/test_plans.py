"""Physical-plan properties the scale design relies on, on executed adaptive plans
of operators that read the frames themselves (before any table is written)."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from framewatch.config import FIXTURE_CONFIG
from framewatch.operators import breaker, drift, qa
from framewatch.plans.pipeline import GatePipeline
from framewatch.session import ensure_checkpoint_dir
from framewatch.sources.frames import feed_subset


def plan(df) -> str:
    """The final plan of an execution of ``df`` itself."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text or "AdaptiveSparkPlan" not in text
    return text.split("\n+- == Initial Plan ==")[0]


@pytest.fixture(scope="module")
def p(spark):
    return GatePipeline.from_sf(spark, SF_SMALL)


def test_windows_read_frames_once_without_nested_loops(spark, p):
    model = p.baseline_model
    t = plan(drift.window_statistics(drift.drift_windows(p.valid, p.batches, model, FIXTURE_CONFIG), model, FIXTURE_CONFIG))
    assert "NestedLoop" not in t and "Cartesian" not in t
    frames = [line for line in t.splitlines() if "FileScan" in line and "embedding" in line]
    assert len(frames) == 1
    limits = [i for i, line in enumerate(t.splitlines()) if "WindowGroupLimit" in line]
    exchanges = [i for i, line in enumerate(t.splitlines()) if "Exchange hashpartitioning(feed_id" in line]
    # rows are cut down on both sides of the one shuffle that also groups them by batch
    assert len(limits) == 2 and any(limits[0] < e < limits[1] for e in exchanges)


def test_no_cross_products_in_reports_and_breaker(spark, p):
    reports = drift.drift_reports(p.valid, p.batches, p.baseline_model, FIXTURE_CONFIG)
    for df in (reports, breaker.breaker_evaluation(p.batch_plan, FIXTURE_CONFIG), drift.drift_status(p.batch_plan, FIXTURE_CONFIG),
               drift.tail_per_camera(p.valid, p.batch_plan, FIXTURE_CONFIG)):
        t = plan(df)
        assert "CartesianProduct" not in t and "BroadcastNestedLoopJoin" not in t


def test_filters_and_columns_reach_the_scan(spark, p):
    t = plan(feed_subset(p.frames, ["camera_1"]).select("seq", "brightness_avg"))
    assert "PartitionFilters: [isnotnull(feed_id" in t and "camera_1" in t
    assert "ReadSchema: struct<seq:bigint,brightness_avg:double>" in t


def test_tail_prunes_batches_before_rows(spark, p):
    t = plan(drift.tail_per_camera(p.valid, p.batches, FIXTURE_CONFIG, n=3))
    lines = t.splitlines()
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert semi and max(i for i, line in enumerate(lines) if "WindowGroupLimit" in line) < max(semi)


def test_batch_table_is_a_hash_aggregation(spark, p):
    t = plan(qa.qa_batches(p.gated))
    partial = [line for line in t.splitlines() if "partial_count" in line]
    assert partial and all("HashAggregate" in line for line in partial if "partial_min(seq" in line)


def test_gate_has_no_python_stage(spark, p):
    t = plan(p.quarantined.select("seq", F.size("failed_rules")))
    assert "BatchEvalPython" not in t and "ArrowEvalPython" not in t and "MapInPandas" not in t


def test_single_reader_queries_write_nothing(spark, p):
    q = GatePipeline(spark, p.frames, FIXTURE_CONFIG)
    q.batch_plan.collect()
    assert not q._written


def test_written_tables_are_deleted(spark, p):
    q = GatePipeline(spark, p.frames, FIXTURE_CONFIG)
    assert q.batches.count() and q._written
    path = q._written[0]
    q.close()
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_stored_feeds_are_written_without_a_sort(spark, tmp_path):
    """Wide rows sorted by folder spill more than is written."""
    from framewatch.sources.frames import FEED_WRITERS, frames_from_events, open_writers
    frames_from_events(spark, SF_SMALL).createOrReplaceTempView("frames_to_write")
    spark.sql(f"CREATE TABLE feeds_written (seq bigint, embedding array<double>, feed_id string) USING parquet PARTITIONED BY (feed_id) LOCATION '{tmp_path}/t'")

    def text():
        return spark.sql("EXPLAIN INSERT INTO feeds_written SELECT seq, embedding, feed_id FROM frames_to_write").first()[0]
    try:
        assert "Sort [feed_id" in text()
        with open_writers(spark, FEED_WRITERS):
            assert "Sort [feed_id" not in text()
        assert "Sort [feed_id" in text()
    finally:
        spark.sql("DROP TABLE feeds_written")
        spark.catalog.dropTempView("frames_to_write")
