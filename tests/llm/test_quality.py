import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from framewatch.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bucket(buckets, *ws):
    h = 42
    for w in ws:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return (h - (1 << 64) if h >> 63 else h) % buckets


def grams(buckets, text):
    w = WORD.findall(text or "")
    return [bucket(buckets, x) for x in w] + [bucket(buckets, a, b) for a, b in zip(w, w[1:])]


def base(text):
    w = WORD.findall(text or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + o for k, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def size_of(rules, n_words):
    buckets = 1
    while buckets < 2 * n_words // rules.grams_a_bucket:
        buckets *= 2
    return min(rules.max_buckets, max(rules.min_buckets, buckets))


def brute(rules, rows, trusted):
    buckets = size_of(rules, sum(len(WORD.findall(t or "")) for i, t in set(rows) if i in trusted))
    texts = [(i, Counter(grams(buckets, t)), base(t)) for i, t in rows]
    raw, target = Counter(), Counter()
    for i, g, _ in texts:
        raw.update(g)
        if i in trusted:
            target.update(g)
    n_raw = sum(raw.values())
    found = []
    for i, g, b in texts:
        seen = target - g if i in trusted else target
        n, m, total = sum(g.values()), sum(seen.values()), 0.0
        for x, c in g.items():
            p = (raw[x] + 1) / (n_raw + buckets)
            total += c * math.log((seen[x] + rules.mixed * m * p) / ((1 + rules.mixed) * m * p)) if m else 0.0
        found.append((i, b, b[0] < rules.min_words or 100 * b[4] > 50 * b[0], round(total / n, 9) if n else None))
    known = sorted({(i, t): f[3] for (i, t), f in zip(rows, found) if i in trusted and not f[2]}.values())
    limit = -math.inf
    if known:
        at = rules.quantile * (len(known) - 1)
        low, high = known[math.floor(at)], known[math.ceil(at)]
        limit = low + (high - low) * (at - math.floor(at))
    return [(i, *b, failed, score, not failed and score >= limit) for i, b, failed, score in found]


def run(docs, labels, rules):
    rows = Q.quality_rules(docs, labels, rules).select(F.col("row.doc_id").alias("doc_id"), "*").collect()
    return [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
             r["base_failed"], r["score"], r["kept"]) for r in rows]


def same(got, want):
    key = lambda r: repr((r[0], r[1:7], r[8]))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:7] == b[:7] and a[8] == b[8]
        assert a[7] == pytest.approx(b[7]) if b[7] is not None else a[7] is None


def test_same_as_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rules = Q.QualityRules()
    trusted = {r["doc_id"] for r in labels.where("quality = 1 and toxic = 0").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same(run(docs, labels, rules), brute(rules, rows, trusted))


def test_defined_cases(spark, edge_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 1, 1), (None, 1, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    rules = Q.QualityRules(min_buckets=64, max_buckets=64)
    clash = edge_docs.withColumn("words", F.lit(3)).withColumn("kept", F.lit("?")).withColumn("ratio", F.lit(None))
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    same(run(clash, labels, rules), brute(rules, rows, {4}))
    same(run(edge_docs, labels.limit(0), rules), brute(rules, rows, set()))
    assert Q.quality_rules(edge_docs.limit(0), labels, rules).count() == 0


def test_repeats_and_lines(spark, make_docs):
    texts = ["a b c a b c", "a a a a", "a b c d", "a b\n a b\na b\n\n \na b", "x y z " * 40, "a b c a b", "", "#*$ %&|<>"]
    got = {r[0]: r[1:6] for r in run(make_docs(texts), spark.createDataFrame([], "doc_id long, quality int, toxic int"), Q.QualityRules(min_buckets=16, max_buckets=16))}
    assert got == {i: base(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_labels(spark, sf):
    """Half of the trusted documents are left out of the target: nearly all of them stay, nearly all bad ones go."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").where("toxic = 0")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    got = Q.quality_rules(docs, labels.where(half)).where("not base_failed").select(F.col("row.doc_id").alias("doc_id"), "kept")
    rest = labels.where(~half | (F.col("quality") == 0))
    share = {r["quality"]: (r["share"], r["n"]) for r in got.join(rest, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("share"), F.count(F.lit(1)).alias("n")).collect()}
    assert share[1][1] > 100 and share[0][1] > 10
    assert share[1][0] >= 0.95 and share[0][0] <= 0.05


def test_one_trusted_text(spark, make_docs):
    texts = ["a b c d e f g h " * 2 + " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))]
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    rules = Q.QualityRules(min_buckets=256, max_buckets=256)
    same(run(make_docs(texts), labels, rules), brute(rules, list(enumerate(texts)), {0}))


def test_buckets_follow_the_target():
    rules = Q.QualityRules()
    assert [Q.bucket_count(n, rules) for n in (0, 8192, 8194, 100_000, 10**9)] == [4096, 4096, 8192, 65536, 1 << 17]


def test_no_python_in_the_plan(spark, make_docs):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    plan = Q.quality_rules(make_docs(["a b", "c"]), labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_trusted_document_counts(spark):
    """More trusted documents than the 10,000 that were drawn before: ids, target and threshold hold all of them."""
    n = 12_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("w "), F.pmod(F.xxhash64("id"), F.lit(97)).cast("string"), F.lit(" "), (F.col("id") % 5).cast("string")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    rules = Q.QualityRules(min_words=1, min_buckets=1024, max_buckets=1024, quantile=0.3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Q.trusted_ids(labels).count() == n
    same(run(docs, labels, rules), brute(rules, rows, set(range(n))))


def test_quantile_is_exact(spark):
    import numpy as np
    values = np.round(np.concatenate([np.random.default_rng(5).normal(0, 3, 400), [0.0] * 40, [-1e-9, 1e-9, 50.123456789]]), 9)
    for some in (values, values[:1], values[:2]):
        df = spark.createDataFrame([(float(x),) for x in some], "x double")
        for q in (0.0, 0.02, 0.31, 0.5, 1.0):
            assert Q.exact_quantile(df, q) == pytest.approx(float(np.quantile(some, q)), abs=1e-12)
    assert Q.exact_quantile(df.limit(0), 0.5) is None


@pytest.mark.parametrize("most_bits", [64, 1 << 12, Q.MOST_BITS])
def test_trusted_ids_are_told_exactly(spark, most_bits):
    """Whatever the number of bits: every trusted id, no other, null ids never, repeated rows as they come."""
    ids = [*range(-300, 300), 5, 5, 1 << 40, None, None]
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    trusted = {i for i in ids if i is not None and i % 3 == 0}
    table = spark.createDataFrame([(i,) for i in trusted | {10**6, 10**6 + 1}], "doc_id long")
    got = [(r["doc_id"], r["trusted"]) for r in Q.tell_trusted(docs, table, most_bits)(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted([(i, i in trusted) for i in ids], key=key)
    none = Q.tell_trusted(docs, table.limit(0), most_bits)(docs)
    assert none.where("trusted").count() == 0 and none.count() == len(ids)


def test_no_text_is_shuffled(spark, tmp_path):
    """With more trusted ids than a broadcast takes, texts and rows stay where they are read."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words"), F.col("id").cast("string")).alias("text")).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"), F.lit(0).alias("toxic"))
    seen = []
    plain = Q.cut
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
        Q.cut = lambda df, name: seen.append(df) or plain(df, name)
        seen.append(Q.quality_rules(docs, labels).drop("row"))
        for df in seen:
            for node in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", df._sc._jvm.PythonSQLUtils.explainString(
                    df._jdf.queryExecution(), "formatted")):
                assert not re.search(r"\b(text|row)#", node)
    finally:
        Q.cut = plain
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
