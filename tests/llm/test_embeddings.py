import numpy as np
import pytest

from framewatch.llm import embed_dedup as E
from framewatch.llm.components import reach


def brute(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            x, y = rows[a][1], rows[b][1]
            if a == b or None in (ids[a], ids[b], rows[a][2], rows[b][2]) or rows[a][2] != rows[b][2]:
                continue
            if any(v is None or not len(v) or any(e is None or not np.isfinite(e) for e in v) or not any(v) for v in (x, y)) or len(x) != len(y):
                continue
            x, y = np.array(x, np.float64), np.array(y, np.float64)
            linked[a, b] = x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    low = reach(n, *np.nonzero(linked))
    least = {}
    for k in range(n):
        if ids[k] is not None:
            least[low[k]] = min(least.get(low[k], ids[k]), ids[k])
    return sorted(((ids[k], int(linked[k].sum()), least.get(low[k]) if ids[k] is not None else None) for k in range(n)), key=repr)


def result(spark, rows, near):
    got = E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), near).collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr)


@pytest.mark.parametrize("tile,block", [(1024, 16), (7, 3)])
def test_same_as_all_pairs(spark, tile, block):
    draw = np.random.default_rng(4)
    rows = []
    for g in range(12):
        base = draw.standard_normal(24) * np.linspace(3, 0.2, 24)
        for _ in range(8):
            v = base + draw.standard_normal(24) * draw.choice([0.02, 0.15, 0.3])
            rows.append([len(rows), v.astype(np.float32).tolist(), int(g % 3)])
    rows[5][1] = rows[3][1]
    rows[6][1] = [2 * x for x in rows[3][1]]
    order = draw.permutation(len(rows))
    rows = [(int(order[i]), v, lab) for i, v, lab in rows]
    assert result(spark, rows, E.NearVectors(tile=tile, block=block)) == brute(rows)


def test_labels_of_any_type(spark):
    rows = [(i, [1.0, 0.01 * i], "ab"[i % 2]) for i in range(6)]
    got = E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (2, i % 2) for i in range(6)}


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(9, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (4, [2.0, 4.0], 1), (5, [1.0, 2.0], None), (6, None, 1),
            (7, [], 1), (8, [0.0, 0.0], 1), (10, [1.0, None], 1), (11, [nan, 1.0], 1), (12, [inf, 1.0], 1), (None, [1.0, 2.0], 1),
            (13, [1.0, 2.0, 0.0], 1), (14, [1.0, 2.0], 2), (15, [-1.0, -2.0], 1), (16, [1e-30, 2e-30], 1), (17, [1e30, 2e30], 1)]
    assert result(spark, rows, E.NearVectors()) == brute(rows)
    assert result(spark, rows[:0] or [(1, None, None)], E.NearVectors()) == [(1, 0, 1)]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, kept string")
    assert E.near_vectors(empty).count() == 0
