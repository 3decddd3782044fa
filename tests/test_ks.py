"""Grouped two-sample KS: statistic vs brute force, exact p-values vs path
enumeration, large-sample p-values vs quoted values and simulation."""
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewatch.config import GateConfig
from framewatch.functions import ks
from framewatch.functions.ks import exact_pvalue_expr, ks_num_expr, large_sample_pvalue_expr
from framewatch.operators.drift import BaselineModel, baseline_rows


def ks_brute(w, b):
    allv = np.concatenate([w, b])
    c1 = np.searchsorted(np.sort(w), allv, side="right") / len(w)
    c2 = np.searchsorted(np.sort(b), allv, side="right") / len(b)
    return np.max(np.abs(c1 - c2))


def enumerated_pvalue(n1, n2, ks_num):
    """The p-value from all lattice paths."""
    hit = total = 0
    for xs in map(set, combinations(range(n1 + n2), n1)):
        total += 1
        i = j = 0
        touched = ks_num <= 0
        for step in range(n1 + n2):
            i, j = (i + 1, j) if step in xs else (i, j + 1)
            touched |= abs(i * n2 - j * n1) >= ks_num
        hit += touched
    return hit / total


def exact_pvalues(spark, triples):
    df = spark.createDataFrame([(k, *t) for k, t in enumerate(triples)], "k int, n1 bigint, n2 bigint, ks_num bigint")
    return [r["p"] for r in df.select("k", exact_pvalue_expr().alias("p")).orderBy("k").collect()]


def test_exact_pvalue_matches_enumeration(spark):
    triples = [(a, b, k) for a, b in ((3, 4), (4, 6), (5, 5), (2, 7), (6, 3)) for k in range(0, a * b + 2)]
    for t, p in zip(triples, exact_pvalues(spark, triples)):
        assert abs(p - enumerated_pvalue(*t)) < 1e-12, t


def test_alpha_boundary(spark):
    """n1 = 20, n2 = 1000: D >= 0.298 drifts."""
    high, low = exact_pvalues(spark, [(20, 1000, 5940), (20, 1000, 5960)])
    assert low < 0.05 < high


def test_ks_statistic_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(7)
    base = np.round(rng.normal(0, 1, 300), 1)          # many ties
    cfg = GateConfig(embedding_dim=2)
    bdf = spark.createDataFrame([(float(x), 0.1, [1.0, 0.0]) for x in base],
                                "brightness_avg double, blur_metric double, embedding array<double>")
    model = BaselineModel.fit(bdf, cfg)
    windows = [np.round(rng.normal(mu, 1, 20), 1) for mu in (0.0, 0.3, 1.5, -2.0)]
    rows = []
    for wi, w in enumerate(windows):
        rows.append((wi, [dict(b=float(x), l=0.1, n=1.0) for x in w]))
    df = spark.createDataFrame(rows, "wid int, pts array<struct<b:double,l:double,n:double>>")
    flat = df.select("wid", F.posexplode("pts").alias("i", "p")).select("wid", "i", "p.*")
    ann = model.annotate(flat)
    win = ann.groupBy("wid").agg(F.collect_list(F.struct("b", "b_ble", "b_blt")).alias("win"))
    got = {r["wid"]: r["kn"] for r in win.select("wid", ks_num_expr("win", "b", model.n2).alias("kn")).collect()}
    for wi, w in enumerate(windows):
        assert got[wi] / (20 * len(base)) == pytest.approx(ks_brute(w, base), abs=1e-12)


def test_large_sample_path(spark):
    """K3: the finite-n distribution of one sample at n = round(n1 n2 / (n1 + n2))."""
    from framewatch.operators.drift import pvalue_table
    rows = [(20, 10001, round(d * 20 * 10001)) for d in (0.29, 0.295, 0.30, 0.05, 0.9)] + [(20, 1000, k) for k in (3000, 5960, 8000, 20000)]
    stats = spark.createDataFrame([(a, b, k, k, k) for a, b, k in rows],
                                  "n1 bigint, n2 bigint, brightness_avg_ks_num bigint, blur_metric_ks_num bigint, embedding_ks_num bigint")
    got = {(r["n2"], r["ks_num"]): r["p_value"] for r in pvalue_table(stats, GateConfig(exact_ks_max_n=500)).collect()}
    assert len(got) == len(rows)
    for d, p in ((0.29, 0.05531), (0.295, 0.04886), (0.30, 0.04307)):
        assert got[10001, round(d * 20 * 10001)] == pytest.approx(p, abs=1e-5)
    # the decision at the boundary, on both sides of it
    assert got[10001, round(0.29 * 20 * 10001)] > 0.05 > got[10001, round(0.295 * 20 * 10001)]
    exact = {k: p for k, p in zip((3000, 5960, 8000), exact_pvalues(spark, [(20, 1000, k) for k in (3000, 5960, 8000)]))}
    for k, p in exact.items():
        assert abs(got[1000, k] - p) < 0.02 and (got[1000, k] < 0.05) == (p < 0.05)
    assert got[1000, 20000] == 0.0 and got[10001, round(0.05 * 20 * 10001)] > 0.999


def test_large_sample_distribution_by_simulation(spark):
    rng = np.random.default_rng(0)
    n = 7
    u = np.sort(rng.random((200_000, n)), axis=1)
    i = np.arange(1, n + 1) / n
    d = np.maximum(i - u, u - (i - 1 / n)).max(axis=1)
    df = spark.createDataFrame([(x,) for x in (0.1, 0.2, 0.35, 0.5, 0.71)], "d double")
    for r in df.select("d", large_sample_pvalue_expr("d", "14", "14").alias("p")).collect():
        assert r["p"] == pytest.approx((d >= r["d"]).mean(), abs=4e-3)


def test_infinite_and_missing_values(spark):
    """Infinite values rank; a NaN or null value leaves no statistic and no drift."""
    inf, nan = float("inf"), float("nan")
    schema = "feed_id string, batch_round int, seq long, brightness_avg double, blur_metric double, embedding array<double>"
    base = spark.createDataFrame([("f", 1, i, 10.0 + i, inf if i < 4 else 0.1 * i, [nan if i == 9 else 1.0, 0.0]) for i in range(10)], schema)
    cfg = GateConfig(embedding_dim=2)
    model = BaselineModel.fit(base, cfg)
    assert model.n2 == 10 and model.cum_le["l"][-1] == 10 and model.values["n"] is None
    rows = model.annotate(base.select(F.col("brightness_avg").alias("b"), F.col("blur_metric").alias("l"), F.lit(1.0).alias("n")))
    win = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("win"))
    got = win.select(*[ks_num_expr("win", f, 10).alias(f) for f in "bln"]).first()
    assert (got["b"], got["l"], got["n"]) == (0, 0, None)


def test_baseline_does_not_depend_on_the_order_of_rows(spark):
    """Two feeds number their rows alike: the feed breaks the ties."""
    rows = [(f, 1, s, 100.0 + s + (f == "camera_2"), 0.1, [1.0, 0.0]) for s in range(10) for f in ("camera_1", "camera_2")]
    schema = "feed_id string, batch_round int, seq long, brightness_avg double, blur_metric double, embedding array<double>"
    a, b = (spark.createDataFrame(x, schema) for x in (rows, rows[::-1]))
    keys = [sorted((r["feed_id"], r["seq"]) for r in baseline_rows(x, GateConfig(), n=5).collect()) for x in (a, b)]
    assert keys[0] == keys[1] == [("camera_1", 0), ("camera_1", 1), ("camera_1", 2), ("camera_2", 0), ("camera_2", 1)]


def test_statistic_of_a_large_window(spark):
    """5,000 values with many ties and infinities: the merge equals both step functions at every point."""
    rng = np.random.default_rng(11)
    base = np.round(rng.normal(0, 1, 400), 1)
    w = np.round(rng.normal(0.1, 1, 5000), 1)
    w[:20], w[20:30] = np.inf, -np.inf
    b = np.sort(base)
    points = [dict(b=float(x), b_ble=int(np.searchsorted(b, x, side="right")), b_blt=int(np.searchsorted(b, x))) for x in w]
    df = spark.createDataFrame([(points,)], "win array<struct<b:double,b_ble:bigint,b_blt:bigint>>")
    s = np.sort(w)
    want = max(max(abs(int(np.searchsorted(s, p["b"], side="right")) * 400 - p["b_ble"] * 5000),
                   abs(int(np.searchsorted(s, p["b"])) * 400 - p["b_blt"] * 5000)) for p in points)
    assert df.select(ks_num_expr("win", "b", 400)).first()[0] == want
    assert want / (400 * 5000) == pytest.approx(ks_brute(w, base), abs=1e-12)


def test_band_equals_whole_diagonals():
    """Large samples walk the band only; n1 = n2 = 5,000 takes a second or two."""
    for a, b in ((65, 65), (70, 90), (100, 333)):
        h = np.unique(np.linspace(1, a * b + 1, 40).astype(int))
        assert ks.exact_pvalues(a, b, h) == pytest.approx(ks._walk_together(a, b, h), abs=1e-12)
    p = ks.exact_pvalues(5000, 5000, np.array([500_000, 675_000, 25_000_000]))
    limit = [2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * d * d * 2500) for k in range(1, 20)) for d in (0.02, 0.027)]
    assert p[:2] == pytest.approx(limit, rel=0.02) and p[2] == 0.0


def test_matrix_and_tail_agree():
    """Where the tail takes over, it equals the matrix to its stated error."""
    for n in (20, 100, 1000, 3000):
        d = (ks.TAIL / n) ** 0.5
        assert ks.one_sided_tail(n, d) == pytest.approx(1 - ks.durbin(n, d), rel=1e-7)
    assert ks.large_sample_pvalue(100_000, 0.02) == pytest.approx(2 * np.exp(-80), rel=0.05)
    assert ks.large_sample_pvalue(100_000, 0.004) == pytest.approx(0.0813, abs=1e-3)
    assert [ks.large_sample_pvalue(10, d) for d in (0.0, 1.0)] == [1.0, 0.0]
    # the published example: n = 10, d = 0.274 has P(D_n < d) = 0.6284796154565043
    assert ks.durbin(10, 0.274) == pytest.approx(0.6284796154565043, abs=1e-12)
