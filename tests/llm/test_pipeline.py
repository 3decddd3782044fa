import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from framewatch.llm import quality
from framewatch.llm.queries import registry, tokenizer_path
from . import test_jaccard, test_mixing, test_quality, test_secrets

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_stage_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit(1)).withColumn("kept", F.lit("x"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trusted = {r["doc_id"] for r in labels.where("quality = 1 and toxic = 0").collect()}

    def step(k, docs):
        P.STAGES[k][1](spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        return spark.read.parquet(str(tmp_path / str(k)))

    was = docs.collect()
    one = step(0, docs)
    verdict = {r[0]: r[-1] for r in test_quality.brute(quality.QualityRules(), [(r["doc_id"], r["text"]) for r in was], trusted)}
    assert rows_of(one) == sorted((tuple(r) for r in was if verdict[r["doc_id"]]), key=repr)

    two = step(1, one)
    texts = [(r["doc_id"], r["text"]) for r in one.collect()]
    groups = test_jaccard.brute(texts, 5, 80)
    assert sorted(r["doc_id"] for r in two.collect()) == sorted({c for _, c in groups.values()})

    three = step(2, two)
    old = {r["doc_id"]: r for r in two.collect()}
    for r in three.collect():
        t = old[r["doc_id"]]["text"]
        assert (r["text"] == t) == (not test_secrets.base(t) and not test_secrets.entropy(t))
        assert r["n_chars"] == len(r["text"])

    four = step(3, three)
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    before, after = Counter(), Counter()
    for r in three.collect():
        before[r["source"]] += size(r)
    for r in four.collect():
        after[r["source"]] += size(r)
    for s, target in test_mixing.brute_targets(dict(before)).items():
        assert abs(after[s] - target) <= max(size(r) for r in three.collect())
    assert max(Counter(r["doc_id"] for r in four.collect()).values()) <= 2
    assert four.columns == three.columns == two.columns == one.columns == docs.columns

    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    text = {r["doc_id"]: r["text"] for r in four.collect()}
    five = step(4, four).collect()
    assert len(five) == four.count()
    for r in five:
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == library.encode(text[r["doc_id"]], add_bos=True, add_eos=True)


def test_stages_take_odd_rows(spark, edge_docs, tmp_path):
    """Nulls, repeated ids and empty tables pass every stage."""
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, edge_docs, SF)
        assert out.collect() is not None
        assert stage(spark, edge_docs.limit(0), SF).count() == 0
        if k < len(P.STAGES) - 1:
            assert out.columns == edge_docs.columns
    left = Counter(r["doc_id"] for r in P.jaccard_join(spark, edge_docs, SF).collect())
    assert left == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 1, None: 2}
    assert P.secrets(spark, edge_docs, SF).count() == edge_docs.count()


def test_unlike_texts_under_one_id_stay(spark):
    draw = np.random.default_rng(2)
    a, b, c = (" ".join(f"w{x}" for x in draw.integers(0, 500, 60)) for _ in range(3))
    rows = [(1, a), (1, b), (1, a), (2, a + " x"), (3, b + " x"), (4, c), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted(((r["doc_id"], r["text"]) for r in P.jaccard_join(spark, docs, SF).collect()), key=repr)
    assert left == sorted([(1, a), (1, b), (4, c), (4, None)], key=repr)


@pytest.mark.parametrize("name", sorted(registry()))
def test_registered_queries_run(spark, name):
    assert registry()[name](spark, SF).count() > 0
