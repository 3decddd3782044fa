"""Batch status (M7, M8), rolling rate (M9, M10), latch (M12), reasons."""
from pyspark.sql import functions as F

from conftest import frame
from framewatch.config import GateConfig
from framewatch.functions.text import percent_text, round4
from framewatch.operators import breaker, drift, qa
from framewatch.plans.pipeline import GatePipeline

CFG = GateConfig(embedding_dim=8)


def batches_of(make_frames, spec, feed="camera_2"):
    """spec: list of (round, n_valid, n_bad)."""
    rows, seq = [], 0
    for rnd, nv, nb in spec:
        for _ in range(nv):
            rows.append(frame(seq, feed=feed, rnd=rnd)); seq += 1
        for _ in range(nb):
            rows.append(frame(seq, feed=feed, rnd=rnd, b=1.0)); seq += 1
    return qa.qa_batches(qa.gate(make_frames(rows), CFG))


def test_status_passed_partial_failed(spark, make_frames):
    b = {r["batch_round"]: r for r in batches_of(make_frames, [(1, 4, 0), (2, 1, 2), (3, 0, 4)]).collect()}
    assert b[1]["status"] == "passed" and b[2]["status"] == "partial_failure" and b[3]["status"] == "failed"
    assert (b[2]["valid_count"], b[2]["quarantined_count"]) == (1, 2)


def test_batch_camera_is_first_row(spark, make_frames):
    rows = [frame(5, cam="invalid_cam"), frame(6), frame(7)]
    b = qa.qa_batches(qa.gate(make_frames(rows), CFG)).collect()[0]
    assert b["camera_id"] == "invalid_cam"


def test_split_mixed(spark, make_frames):
    g = qa.gate(make_frames([frame(0), frame(1, b=300.0), frame(2, cam="camera_x")]), CFG)
    assert sorted(r["seq"] for r in qa.valid_frames(g).collect()) == [0]
    assert sorted(r["seq"] for r in qa.quarantined_frames(g).collect()) == [1, 2]
    kept, dropped = qa.split_by_semi_anti(g)
    assert sorted(r["seq"] for r in kept.collect()) == [0]
    assert sorted(r["seq"] for r in dropped.collect()) == [1, 2]


def test_rolling_rate_half(spark, make_frames):
    ev = breaker.breaker_evaluation(batches_of(make_frames, [(1, 4, 0), (2, 0, 4)]), CFG)
    rates = {r["batch_round"]: r["rolling_quarantine_rate"] for r in ev.collect()}
    assert rates == {1: 0.0, 2: 0.5}


def test_trip_at_round_6_once(spark, make_frames):
    spec = [(r, 4, 0) for r in range(1, 6)] + [(6, 0, 4), (7, 0, 4)]
    ev = breaker.breaker_evaluation(batches_of(make_frames, spec), CFG).orderBy("batch_round").collect()
    trips = [r["batch_round"] for r in ev if r["trip_ordinal"] == 1]
    suppressed = [r["batch_round"] for r in ev if r["trip_ordinal"] is not None and r["trip_ordinal"] > 1]
    assert trips == [6] and suppressed == [7]
    r6 = ev[5]
    assert abs(r6["rolling_quarantine_rate"] - 0.2) < 1e-12
    assert r6["reasons"][0]["type"] == "qa_quarantine_rate_exceeded"
    assert r6["reasons"][0]["message"] == "QA quarantine rate 20.00% exceeds 15.00% threshold."
    assert [r["breaker_state"] for r in ev] == ["closed"] * 5 + ["tripped", "open"]


def test_rate_threshold_is_strict(spark, make_frames):
    # 3 quarantined of 20 rows over five batches = exactly 0.15: no trip
    spec = [(1, 4, 0), (2, 4, 0), (3, 4, 0), (4, 4, 0), (5, 1, 3)]
    ev = breaker.breaker_evaluation(batches_of(make_frames, spec), CFG).collect()
    assert not any(r["should_trip"] for r in ev)


def test_unknown_camera_ignored(spark, make_frames):
    b = batches_of(make_frames, [(1, 0, 4)], feed="camera_9")
    assert breaker.breaker_evaluation(b, CFG).count() == 0


def test_multi_feature_drift_reason_order(spark, make_frames):
    b = batches_of(make_frames, [(1, 4, 0)])
    rep = spark.createDataFrame(
        [("camera_2", "camera_2", 1, "analyzed", True, 20, True, False, True, {})],
        "feed_id string, camera_id string, batch_round int, status string, drift_detected boolean, "
        "window_size int, brightness_avg_drift boolean, blur_metric_drift boolean, embedding_drift boolean, "
        "features map<string,double>")
    ev = breaker.breaker_evaluation(b, CFG, rep).collect()[0]
    assert ev["should_trip"]
    r = ev["reasons"][0]
    assert r["type"] == "multi_feature_drift" and r["features"] == ["brightness_avg", "embedding"]
    assert r["message"] == "Drift detected across 2 features: brightness_avg, embedding."


def test_percent_text_ties_to_even(spark):
    df = spark.createDataFrame([(1 / 32,), (0.2,), (0.15,)], "x double")
    got = [r[0] for r in df.select(percent_text(F.col("x"))).collect()]
    assert got == ["3.12%", "20.00%", "15.00%"]


def test_rounding_follows_the_binary_value(spark):
    """Python's rounding, for every rate of up to 4000 rows that may look like a tie."""
    rates = sorted({a / b for b in (32, 160, 400, 800, 2000, 4000, 20000) for a in range(0, b + 1, max(1, b // 4000))})
    df = spark.createDataFrame([(x,) for x in rates + [3 / 20000, 1 / 4000]], "x double")
    for r in df.select("x", percent_text(F.col("x")).alias("p"), round4(F.col("x")).alias("r")).collect():
        assert r["p"] == f"{r['x']:.2%}" and r["r"] == round(r["x"], 4), r


def test_times_are_utc_in_any_session_zone(spark, make_frames):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = [frame(0, ts="2026-01-01T00:00:00+00:00"), frame(1, rnd=2, ts="2026-03-08T02:30:00.5"), frame(2, rnd=3, ts="2026-01-01T00:00:00.123456+02:00")]
    want = ["2026-01-01T00:00:00.000000", "2026-03-08T02:30:00.500000", "2025-12-31T22:00:00.123456"]
    try:
        for z in ("America/New_York", "UTC", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = qa.qa_batches(qa.gate(make_frames(rows), CFG)).orderBy("batch_round").collect()
            assert [r["last_timestamp"] for r in got] == want, z
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_feeds_of_one_camera_follow_the_configured_order(spark, make_frames):
    """camera_10 comes after camera_2, as configured, not before it as in text order."""
    cfg = CFG.with_(known_cameras=("camera_1", "camera_2", "camera_10"))
    rows = [frame(s, feed=f, cam="camera_2", rnd=1) for f in ("camera_10", "camera_2") for s in range(3)]
    b = qa.qa_batches(qa.gate(make_frames(rows), cfg))
    got = {r["feed_id"]: r["buffer_total"] for r in drift.drift_buffer(b, cfg).collect()}
    assert got == {"camera_2": 3, "camera_10": 6}


def test_schema_level_alerts_and_fallback(spark, make_frames):
    from framewatch.functions.rules import contract_violations
    df = make_frames([frame(0), frame(1, b=300.0)])
    g = qa.gate(df, CFG)
    b = qa.qa_batches(g)
    v = contract_violations(df.drop("frame_id"))
    sch = qa.batch_alerts(b, v)
    row = sch.collect()[0]
    assert row["row_index"] is None and row["failed_rules"][0]["check"] == "column_in_dataframe"
    # a quarantined row with no row-level alert falls back to the batch's rules
    bare = qa.quarantined_frames(g).withColumn("failed_rules", F.filter("failed_rules", lambda r: F.lit(False)))
    out = qa.row_rules_fallback(bare, sch).collect()
    assert [r["failed_rules"][0]["check"] for r in out] == ["column_in_dataframe"]
    own = qa.row_rules_fallback(qa.quarantined_frames(g), sch).collect()
    assert [r["failed_rules"][0]["check"] for r in own] == ["_brightness_valid"]
    reasons = qa.quarantine_reasons(bare.withColumn("is_valid", F.lit(False)), b, v).collect()
    assert [r["failed_rules"][0]["check"] for r in reasons] == ["column_in_dataframe"]
    assert qa.batch_alerts(b, []).count() == 0


def test_broken_schema_from_end_to_end(spark, make_frames):
    """A missing column quarantines nothing; one that cannot be read makes the status error."""
    df = make_frames([frame(0), frame(1, b=300.0)])
    for name in ("camera_id", "blur_metric", "embedding", "timestamp"):
        p = GatePipeline(spark, df.drop(name), CFG)
        got = p.batch_plan.collect()[0]
        assert (got["status"], got["valid_count"], got["quarantined_count"]) == ("partial_failure", 1, 1), name
        assert [v["check"] for v in p.violations] == ["column_in_dataframe"]
    p = GatePipeline(spark, df.withColumn("embedding", F.lit("[1, 2]")), CFG)
    assert p.batch_plan.collect()[0]["status"] == "error" and p.quarantined.count() == 1


def test_last_drift_report_per_camera_wins(spark):
    # Two reports name camera_2 in round 3; the later feed's report is used
    rep = spark.createDataFrame(
        [("camera_10", "camera_2", 3, "buffering", False, None),
         ("camera_2", "camera_2", 3, "analyzed", False, 20)],
        "feed_id string, camera_id string, batch_round int, status string, drift_detected boolean, "
        "window_size int")
    out = breaker.latest_drift_per_camera(rep, CFG.with_(known_cameras=("camera_1", "camera_2", "camera_10"))).collect()
    assert len(out) == 1 and out[0]["status"] == "buffering"
