from pyspark.sql import functions as F

from framewatch.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.where("doc_id % 3 = 0"))
    rest = docs.where("doc_id % 3 <> 0")
    got = L.fuse(L.document_evidence(rest), model).select("doc_id", F.col("lang").alias("found"))
    right = got.join(rest, "doc_id").agg(F.avg((F.col("found") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97


def test_evidence_decides_when_text_is_short(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(L.labelled_sample(docs, L.Fusion(sample=100)))
    text = {r["lang"]: r["text"] for r in docs.where("length(text) > 400").dropDuplicates(["lang"]).collect()}
    rows = [(i, text[lang], lang, "de" if lang == "de" else "com", f"{lang}.example", f"www.{lang}.example")
            for i, lang in enumerate(["de"] * 30 + ["en"] * 30 + ["fr"] * 30)]
    rows += [(900, "", "de", "de", "de.example", "www.de.example"), (901, None, None, None, "fr.example", "new.fr.example"),
             (902, None, None, None, None, None), (903, "", "fr", None, None, None)]
    df = spark.createDataFrame(rows, "id int, text string, declared string, suffix string, domain string, host string")
    got = {r["id"]: r for r in L.fuse(df, model).collect()}
    assert len(got) == len(rows)
    assert [got[i]["lang"] for i in (0, 40, 80, 900, 902, 903)] == ["de", "en", "fr", "de", "und", "fr"]
    assert got[902]["confidence"] == 0 and got[900]["text_lang"] is None


def test_defined_cases(spark, edge_docs):
    pages = spark.createDataFrame([(1, None, None), (2, "not a url", "<html lang=DE-at><p>x"), (None, "http://u@h.example.org:8/x", "<!-- a --><b>text</b>")],
                                  "page_id long, url string, html string")
    got = L.identify(edge_docs, pages).collect()
    assert len(got) == edge_docs.count() + 3
    assert L.identify(edge_docs.limit(0), pages.limit(0)).count() == 0
    assert {r["lang"] for r in L.identify(edge_docs.withColumn("lang", F.lit(None).cast("string")), pages).collect()} == {"und"}
    e = {r["page_id"]: r for r in L.page_evidence(pages).collect()}
    assert (e[2]["declared"], e[2]["host"]) == ("de", None)
    assert (e[None]["host"], e[None]["domain"], e[None]["suffix"], e[None]["text"].strip()) == ("h.example.org", "example.org", "org", "text")


def test_long_text_in_chunks(monkeypatch):
    text = "The quick brown fox. " * 50
    import numpy as np
    whole = np.concatenate(list(L.trigrams(text)))
    monkeypatch.setattr(L, "CHUNK", 7)
    assert (np.concatenate(list(L.trigrams(text))) == whole).all() and len(whole) == len(text)
