"""Drift windows and reports (M15..M20, FIXTURES A3)."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import frame
from framewatch.config import GateConfig
from framewatch.operators import breaker, drift, qa

CFG = GateConfig(embedding_dim=8)
RNG = np.random.default_rng(42)


@pytest.fixture(scope="module")
def model(spark):
    n = 300
    b = np.clip(RNG.normal(165, 10, n), 10, 255)
    l = np.clip(RNG.normal(0.12, 0.03, n), 0, None)
    e = RNG.normal(0, 1, (n, 8))
    df = spark.createDataFrame([(float(b[i]), float(l[i]), [float(x) for x in e[i]]) for i in range(n)],
                               "brightness_avg double, blur_metric double, embedding array<double>")
    return drift.BaselineModel.fit(df, CFG)


def rows_for(batches_spec):
    """batches_spec: list of (feed, round, list of (b, blur, emb_mean))."""
    rows, seq = [], 0
    for feed, rnd, pts in batches_spec:
        for b, l, m in pts:
            rows.append(frame(seq, feed=feed, rnd=rnd, b=float(b), blur=float(l),
                              emb=[float(x) for x in RNG.normal(m, 1.0 if m == 0 else 1.5, 8)]))
            seq += 1
    return rows


def reports(spark, make_frames, model, spec, cfg=CFG):
    g = qa.gate(make_frames(rows_for(spec)), cfg)
    r = drift.drift_reports(qa.valid_frames(g), qa.qa_batches(g), model, cfg)
    return {(x["feed_id"], x["batch_round"]): x for x in r.collect()}


def healthy(n):
    return [(RNG.normal(165, 10), abs(RNG.normal(0.12, 0.03)), 0) for _ in range(n)]


def test_buffering_then_analyzed_no_drift(spark, make_frames, model):
    spec = [("camera_1", 1, healthy(4))] + [("camera_1", r, healthy(4)) for r in range(2, 7)]
    rep = reports(spark, make_frames, model, spec)
    assert rep[("camera_1", 1)]["status"] == "buffering" and rep[("camera_1", 1)]["buffer_size"] == 4
    assert rep[("camera_1", 4)]["status"] == "buffering" and rep[("camera_1", 4)]["buffer_size"] == 16
    a = rep[("camera_1", 5)]
    assert a["status"] == "analyzed" and a["window_size"] == 20 and a["buffer_size"] is None
    assert not a["brightness_avg_drift"]


def test_brightness_shift_drifts(spark, make_frames, model):
    spec = [("camera_1", 1, [(RNG.normal(80, 1), 0.12, 0) for _ in range(20)])]
    a = reports(spark, make_frames, model, spec)[("camera_1", 1)]
    assert a["status"] == "analyzed" and a["brightness_avg_drift"] and a["drift_detected"]
    assert a["brightness_avg_p"] < 0.05


def test_embedding_shift_drifts(spark, make_frames, model):
    spec = [("camera_1", 1, [(165.0 + i * 0.1, 0.12, 4.0) for i in range(20)])]
    a = reports(spark, make_frames, model, spec)[("camera_1", 1)]
    assert a["embedding_drift"] and a["mean_euclidean_distance"] > 2.0


def test_window_spans_batches(spark, make_frames, model):
    spec = [("camera_1", 1, healthy(10)), ("camera_1", 2, [(RNG.normal(70, 1), 0.12, 0) for _ in range(10)])]
    rep = reports(spark, make_frames, model, spec)
    assert rep[("camera_1", 1)]["status"] == "buffering"
    a = rep[("camera_1", 2)]
    assert a["status"] == "analyzed" and a["window_size"] == 20 and a["brightness_avg_drift"]


def test_empty_and_unknown_camera(spark, make_frames, model):
    spec = [("camera_1", 1, healthy(4)), ("camera_1", 2, [(1.0, 0.1, 0)] * 4),
            ("camera_9", 1, healthy(4)), ("camera_9", 2, [(1.0, 0.1, 0)] * 4)]
    rep = reports(spark, make_frames, model, spec)
    e = rep[("camera_1", 2)]
    assert (e["status"], e["reason"], e["buffer_size"]) == ("skipped", "empty_input", 4)
    u = rep[("camera_9", 1)]
    assert (u["status"], u["reason"], u["buffer_size"]) == ("skipped", "unknown_camera", None)
    # empty input is tested before the unknown camera (M15); buffer of an unknown camera is 0
    ue = rep[("camera_9", 2)]
    assert (ue["status"], ue["reason"], ue["buffer_size"]) == ("skipped", "empty_input", 0)


def test_centroid_metrics_identical_sets(spark, model):
    # a window equal to the baseline centroid has similarity 1 and distance 0
    c = model.centroid
    df = spark.createDataFrame([([1] * 20, [20 * x for x in c])], "win array<int>, centre array<double>")
    out = df.select(*[v.alias(k) for k, v in drift.centroid_exprs(model, CFG).items()]).collect()[0]
    assert out["mean_cosine_similarity"] == pytest.approx(1.0, abs=1e-12)
    assert out["mean_euclidean_distance"] == pytest.approx(0.0, abs=1e-12)


def test_empty_side_defaults(spark):
    # K8: with no baseline vectors the centroid metrics fall back to (1.0, 0.0)
    m = drift.BaselineModel(n2=1, values={"b": [1.0], "l": [1.0], "n": [1.0]},
                            cum_le={"b": [0, 1], "l": [0, 1], "n": [0, 1]}, centroid=[], centroid_norm=0.0)
    df = spark.createDataFrame([([1], [1.0] * 8)], "win array<int>, centre array<double>")
    out = df.select(*[v.alias(k) for k, v in drift.centroid_exprs(m, CFG).items()]).collect()[0]
    assert (out["mean_cosine_similarity"], out["mean_euclidean_distance"]) == (1.0, 0.0)


def test_sliding_sum_is_the_sum_of_the_window():
    """Also with infinite and huge vectors, which leave no trace once they are gone."""
    rng = np.random.default_rng(3)
    vectors = [rng.normal(0, 1, 4) for _ in range(400)]
    vectors[50] = np.full(4, np.inf)
    vectors[120] = np.full(4, 1e300)
    for w in (1, 2, 7, 60):
        total, late = drift.SlidingSum(w), drift.SlidingSum(w)
        for k, v in enumerate(vectors):
            total.push(k + 1, v)
            want = np.sum(vectors[max(0, k - w + 1):k + 1], axis=0)
            np.testing.assert_allclose(total.total(k + 1), want, rtol=1e-12, atol=1e-12)
            if k >= 200 - w:                     # a task that begins with a halo gets the same bits
                late.push(k + 1, v)
                assert k < 200 or (late.total(k + 1) == total.total(k + 1)).all()


@pytest.mark.parametrize("w,chunk", [(20, 1 << 16), (5, 7), (64, 100)])
def test_windows_and_centres_match_plain_python(spark, make_frames, model, w, chunk):
    """Batches of 1 to 90 rows of two cameras; windows span batches and chunks."""
    rng = np.random.default_rng(9)
    cfg = CFG.with_(drift_window=w, chunk_positions=chunk)
    spec = [(f"camera_{c}", r, healthy(int(rng.choice([1, 4, 30, 90])))) for r in range(1, 12) for c in (1, 2)]
    frames = rows_for(spec)
    g = qa.gate(make_frames(frames), cfg)
    got = {(r["feed_id"], r["batch_round"]): r for r in drift.drift_windows(qa.valid_frames(g), qa.qa_batches(g), model, cfg).collect()}
    assert len(got) == len(spec)
    for feed, rnd, _ in spec:
        tail = sorted(f[0] for f in frames if f[1] == feed and f[2] <= rnd)[-w:]
        assert [p["seq"] for p in got[feed, rnd]["win"]] == tail
        np.testing.assert_allclose(got[feed, rnd]["centre"], np.sum([frames[s][8] for s in tail], axis=0), rtol=1e-12, atol=1e-12)


def test_large_windows(spark, make_frames, model):
    """W = 5,000: statistics of windows that overlap almost whole, in seconds."""
    cfg = CFG.with_(drift_window=5000, min_drift_features=1)
    rng = np.random.default_rng(1)
    rows = [frame(k, rnd=1 + k // 200, b=float(rng.normal(165, 10)), blur=0.1, emb=[float(x) for x in rng.normal(0, 1, 8)]) for k in range(6000)]
    g = qa.gate(make_frames(rows), cfg)
    got = [r for r in drift.drift_reports(qa.valid_frames(g), qa.qa_batches(g), model, cfg).collect() if r["status"] == "analyzed"]
    assert len(got) == 6 and all(r["window_size"] == 5000 for r in got)
    last = max(got, key=lambda r: r["batch_round"])
    from test_ks import ks_brute
    base = np.repeat(model.values["b"], np.diff(model.cum_le["b"]))
    assert last["brightness_avg_ks"] == pytest.approx(ks_brute([r[6] for r in rows[1000:]], base), abs=1e-12)


def test_only_drifted_reports_asked_for(spark, make_frames, model):
    """A condition on the flags leaves the p-values where they are computed."""
    spec = [("camera_1", 1, [(RNG.normal(80, 1), 0.12, 0) for _ in range(20)]), ("camera_2", 1, healthy(20)), ("camera_3", 1, healthy(4))]
    g = qa.gate(make_frames(rows_for(spec)), CFG)
    r = drift.drift_reports(qa.valid_frames(g), qa.qa_batches(g), model, CFG)
    every = {(x["feed_id"], x["batch_round"]) for x in r.collect() if x["drift_detected"]}
    asked = r.where((F.col("status") == "analyzed") & F.col("drift_detected")).withColumnRenamed("status", "drift_status")
    names = breaker.drifted_features_expr(asked)
    found = asked.select("feed_id", "batch_round", F.array_join(names, ", ").alias("names"), F.size(names).alias("n")).collect()
    assert ("camera_1", 1) in every and {(x["feed_id"], x["batch_round"]) for x in found} == every
    assert all(x["n"] == len(x["names"].split(", ")) for x in found)
    assert "brightness_avg" in next(x["names"] for x in found if x["feed_id"] == "camera_1")
