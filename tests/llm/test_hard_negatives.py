import math

import numpy as np
import pytest

from framewatch.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, mine):
    v = []
    for i, e, lab in rows:
        if None in (i, e, lab) or not e or None in e or not np.isfinite(e).all():
            continue
        lab = (abs(lab + 1) % 10) * (1 if lab + 1 >= 0 else -1) if i % 7 == 0 else lab
        v.append((i, lab, [math.floor(256 * float(np.float32(x))) for x in e]))
    out, seen = [], set()
    for k, (i, lab, q) in enumerate(v):
        if i % mine.every or (i, lab, tuple(q)) in seen:
            continue
        seen.add((i, lab, tuple(q)))
        others = [(-sum(x * y for x, y in zip(q, r)), j, m) for n, (j, m, r) in enumerate(v) if n != k and len(r) == len(q)]
        for w, (p, j, _) in enumerate(sorted(x for x in others if x[2] == lab)[:5]):
            fit = sorted((s, n) for s, n, m in others if m != lab and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(i, j, r + 1, n, -p, -s, w + 1) for r, (s, n) in enumerate(fit[:3])]
    return sorted(out)


def got(spark, rows, mine):
    return sorted(tuple(r) for r in H.hard_negatives(spark.createDataFrame(rows, SCHEMA), mine).collect())


def test_curve_visits_neighbours():
    """Every cell once, and each next one is a step of one along one axis."""
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
        key = H.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    draw = np.random.default_rng(1)
    a, q = draw.integers(-300, 300, (7, 9)), draw.integers(-300, 300, (50, 9))
    under, over = H.score_bounds(a, q.min(axis=0)[None].astype(float), q.max(axis=0)[None].astype(float))
    scores = H.inner(a, q)
    assert (scores == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in q] for r in a]).all()
    assert (under <= scores.min(axis=1, keepdims=True)).all() and (scores.max(axis=1, keepdims=True) <= over).all()
    big = np.array([[1 << 40, 3]])
    assert H.inner(big, np.array([[1 << 20, 5], [1 << 40, 0], [-(1 << 40), 0]])).tolist() == [[(1 << 60) + 15, 1 << 62, -(1 << 62)]]


@pytest.mark.parametrize("mine", [H.HardNegatives(every=9), H.HardNegatives(every=9, block=16, page=3, sample=100, bits=4, axes=3)])
def test_same_as_all_pairs(spark, mine):
    draw = np.random.default_rng(8)
    rows = []
    for g in range(15):
        base = draw.standard_normal(12) * np.linspace(1, 0.1, 12)
        for _ in range(20):
            rows.append((int(draw.integers(0, 400)), (base + 0.3 * draw.standard_normal(12)).tolist(), int(draw.integers(0, 3)) if g else 1))
    rows = list({r[0]: r for r in rows}.values())
    want = brute(rows, mine)
    assert len(want) > 100 and got(spark, rows, mine) == want


def test_bounds_choose_few_blocks(spark):
    """Far clusters: an anchor reads few blocks."""
    draw = np.random.default_rng(8)
    base = 4 * draw.standard_normal((40, 16))
    rows = [(int(i), (base[i % 40] + 0.05 * draw.standard_normal(16)).tolist(), int(i % 40 % 10)) for i in range(2000)]
    mine = H.HardNegatives(block=50, page=8)
    blocks = H.write_blocks(H.integers(spark.createDataFrame(rows, SCHEMA), mine), mine)
    anchors, pages = H.own_anchors(blocks, mine), H.zone_pages(blocks, mine)
    read = sum(len(r["a_ids"]) // 8 for r in H.choose(anchors, pages, True).collect())
    assert read < 0.2 * blocks.count() * 40


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    mine = H.HardNegatives(every=10)
    rows = [(10, [1.0, 0.5], 1), (10, [1.0, 0.5], 1), (10, [0.2, 0.5], 1), (11, [1.0, 0.25], 1), (12, [0.5, 0.5], 2), (13, [0.5, 0.5], 2), (14, [0.6, 0.5], -3),
            (None, [1.0, 1.0], 1), (20, [1.0, 1.0], None), (30, None, 1), (40, [], 1), (50, [nan, 1.0], 1), (60, [inf, 1.0], 1), (70, [None, 1.0], 1),
            (80, [1.0, 2.0, 3.0], 1), (90, [-1.0, -1.0], 1), (100, [0.0, 0.0], 3), (15, [0.0, 0.0], 3), (16, [0.0, 0.1], 4)]
    assert got(spark, rows, mine) == brute(rows, mine)
    assert got(spark, rows[7:14], mine) == []
    empty = spark.createDataFrame([], SCHEMA + ", block string, q string, chunk string")
    assert H.hard_negatives(empty, mine).count() == 0
    clash = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], empty.schema)
    assert sorted(tuple(r) for r in H.hard_negatives(clash, mine).collect()) == brute(rows, mine)
