import numpy as np
import pytest

from framewatch.llm import nearest as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, near):
    """All answers of every query, best first, from the original vectors."""
    fine = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (i, a) in enumerate(fine):
        if i % near.every:
            continue
        a = a / np.abs(a).max()
        found = []
        for k, (j, b) in enumerate(fine):
            if k != at and len(a) == len(b):
                b = b / np.abs(b).max()
                found.append((-(a @ b) / np.sqrt((a @ a) * (b @ b)), j))
        out[i] = sorted(found)
    return out


def answers(spark, rows, near, schema=SCHEMA):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, schema)
    got = {}
    for r in sorted(N.nearest(df, near).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for found in got.values():
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
    return got


def recall(got, want, near):
    hit = total = 0
    for i, best in want.items():
        k = min(near.k, len(best))
        scores = {j: -s for s, j in best}
        for _, j, s in got.get(i, []):
            assert s == pytest.approx(scores[j], abs=1e-12)
        assert len(got.get(i, [])) == k
        hit += sum(s >= -best[k - 1][0] - 1e-12 for _, _, s in got.get(i, []))
        total += k
    return hit / max(1, total)


def test_chi_square_quantile():
    assert N.chi_square_quantile(0.95, 10) == pytest.approx(18.307, abs=1e-3)
    assert N.chi_square_quantile(0.99, 2) == pytest.approx(9.2103, abs=1e-3)


@pytest.mark.parametrize("near", [N.Nearest(), N.Nearest(cell=100, tile=60, leaf=8, chunk=5, sample=700)])
def test_recall_on_the_given_table(spark, near):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    assert recall(answers(spark, df, near), brute(rows, near), near) >= 0.95


def test_recall_in_clusters(spark):
    """Clusters of near copies, where most of the index is never read."""
    draw = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        base = draw.standard_normal(32)
        rows += [(len(rows) + i, (base + 0.05 * draw.standard_normal(32)).tolist(), 0) for i in range(40)]
    near = N.Nearest(cell=80, tile=40, leaf=8, chunk=16, every=20)
    assert recall(answers(spark, rows, near), brute(rows, near), near) >= 0.95


def test_the_stop_prunes():
    draw = np.random.default_rng(5)
    near = N.Nearest()
    base = draw.standard_normal((50, 64))
    u = N.unit_rows(np.repeat(base, 100, axis=0) + 0.05 * draw.standard_normal((5000, 64)))
    p = u @ N.directions(64, near)
    tree = N.Tree(p, 6)
    x = N.chi_square_quantile(near.confidence, near.axes)
    radius = np.sort(2 - 2 * u[:50] @ u.T, axis=1)[:, near.k]
    reached = (N.box_distance(p[:50], tree.lo, tree.hi) <= (radius * x)[:, None]).mean()
    assert reached < 0.25
    cells = tree.cells(p)
    assert (N.box_distance(p, tree.lo, tree.hi)[np.arange(len(p)), cells] == 0).all()


def test_copies_and_ties(spark):
    """Large groups of copies, and vectors of one direction: ties go to smaller ids."""
    draw = np.random.default_rng(2)
    near = N.Nearest(cell=20, tile=8, leaf=4, chunk=3, every=10)
    a, b = draw.integers(-8, 8, (2, 8)).astype(float)
    rows = [(i, (a if i % 3 else b).tolist(), 0) for i in range(120)]
    rows += [(120 + i, draw.standard_normal(8).tolist(), 0) for i in range(60)]
    want = brute(rows, near)
    got = answers(spark, rows, near)
    for i in range(0, 120, 10):
        assert [j for _, j, _ in got[i]] == [j for _, j in sorted((round(s, 9), j) for s, j in want[i])[:5]]
    assert recall(got, want, near) >= 0.9


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    near = N.Nearest(every=5)
    rows = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], None), (6, [2.0, 4.0], 1), (None, [1.0, 2.0], 1), (10, None, 1), (15, [], 1),
            (20, [0.0, 0.0], 1), (25, [1.0, None], 1), (30, [nan, 1.0], 1), (35, [inf, 1.0], 1), (7, [-1.0, 2.0], 1), (40, [1.0, 2.0, 3.0], 1),
            (45, [1e30, 2e30], 1), (50, [1e-30, 2e-30], 1)]
    got = answers(spark, rows, near)
    assert {i: len(f) for i, f in got.items()} == {5: 5, 45: 5, 50: 5}
    assert [(j, round(s, 9)) for _, j, s in got[5]][-1] == (7, 0.6) and {j for _, j, _ in got[5]} == {5, 6, 45, 50, 7}
    assert got[45][0][1:] == (5, pytest.approx(1))
    assert answers(spark, [(5, [1.0], 0)], near) == {}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, score string, key string, v int")
    assert N.nearest(empty).count() == 0
    clash = spark.createDataFrame([(r[0], r[1], "x", "y", 1) for r in rows], empty.schema)
    assert {i: len(f) for i, f in answers(spark, clash, near).items()} == {5: 5, 45: 5, 50: 5}


def test_one_answer_a_query_whatever_the_tiles(spark):
    """Near copies in many tiles: a task gives the best points of all of them, not those of each."""
    draw = np.random.default_rng(8)
    near = N.Nearest(cell=40, leaf=4, chunk=10)
    u = N.unit_rows(draw.standard_normal(6) + 0.01 * draw.standard_normal((40, 6)))
    p = u @ N.directions(6, near)
    ids = np.full((40, near.k + 1), N.NO_ID)
    ids[:, 0] = np.arange(40)
    q, open_bound = np.arange(10), np.full(10, np.inf)
    rows = [(6, *(bytearray(m[at:at + 4].tobytes()) for m in (ids, u, p)), 7, bytearray(q.tobytes()), bytearray((100 + q).tobytes()),
             *(bytearray(m.tobytes()) for m in (u[:10], p[:10], open_bound))) for at in range(0, 40, 4)]
    pairs = spark.createDataFrame(rows, "d int, ids binary, u binary, p binary, chunk long, q binary, keys binary, qu binary, qp binary, bound binary").coalesce(1)
    got = N.search(pairs, near).collect()
    assert len(got) == 10 * (near.k + 1)
    for i in range(10):
        best = sorted((-float(s), j) for j, s in enumerate(u @ u[i]))[:near.k + 1]
        assert [r["ids"] for r in got if r["q"] == i and r["key"] == 100 + i and r["chunk"] == 7] == [[j] for _, j in best]
