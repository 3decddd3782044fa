from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from framewatch.llm import mixing as M


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Reshare what is above the limits until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: most * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def rows(spark, n=600):
    data = [(i, "".join("w " for _ in range((i * 7919) % 61)), ("z", "ü", "a", None, "b")[0 if i % 3 == 0 else i % 5]) for i in range(n)]
    data += [(1, "same " * 9, "a")] * 30 + [(None, "x y", "a"), (None, "x y", "a"), (9999, None, "only nothing"), (9998, "", "b")]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def collect(df, mix=M.Mix()):
    return [tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in M.mixed(df, mix).collect()]


@pytest.mark.parametrize("group", [64, 4])
def test_targets_and_sums(spark, group):
    df = rows(spark)
    plain = [(r["doc_id"], len((r["text"] or "").split()), r["source"]) for r in df.collect()]
    sizes = defaultdict(int)
    for _, n, s in plain:
        sizes[s] += n
    want = brute_targets(dict(sizes))
    got = M.mix_sources(M.word_sizes(df), M.Mix(group=group)).collect()
    assert sorted((r["doc_id"], r["size"], r["source"]) for r in got if r["doc_id"] is not None) == sorted(x for x in plain if x[0] is not None)
    assert len(got) == len(plain)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    largest = max(n for _, n, _ in plain)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest


def test_reruns_agree(spark):
    df = rows(spark)
    a, b = collect(df), collect(df.repartition(7, F.rand(3)).withColumn("size", F.lit(0)).withColumn("k", F.lit(0)))
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_every_document_is_taken_by_its_share(spark):
    """Over many seeds the mean number of copies is the target's share."""
    sizes = spark.createDataFrame([(i, "s" if i % 4 else "t", 1 + i % 7) for i in range(24)], "doc_id long, source string, size long")
    mean = defaultdict(float)
    for seed in range(12):
        for r in M.mix_sources(sizes, M.Mix(weights=(3, 1), seed=seed, group=4)).collect():
            mean[r["doc_id"]] += r["copies"] / 12
            share = r["target"] / r["source_size"]
            assert r["copies"] in (int(share), int(share) + 1 if share % 1 else int(share))
    assert sum(mean.values()) / 24 == pytest.approx(1.5, abs=0.3)


def test_empty(spark):
    assert M.mixed(rows(spark).limit(0)).count() == 0
    assert collect(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")) == [(1, 0, 0, 0.0, 0)]


def test_rows_of_one_id_and_unlike_size(spark, edge_docs):
    """Each row comes back once, whatever else has its id and source."""
    data = [(i % 3 if i % 4 else None, "w " * (1 + i), "ab"[i % 2]) for i in range(40)]
    for df in (edge_docs, spark.createDataFrame(data, "doc_id long, text string, source string")):
        for group in (64, 4):
            got = M.mix_sources(M.word_sizes(df), M.Mix(group=group)).collect()
            want = M.word_sizes(df).collect()
            assert sorted(map(repr, ((r["doc_id"], r["source"], r["size"]) for r in got))) == sorted(map(repr, map(tuple, want)))
            assert all(0 <= r["copies"] <= 2 for r in got)
