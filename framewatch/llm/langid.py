"""Language identification by Bayesian fusion of evidence.

A text's likelihood under every language comes from hashed character trigrams.
Its posterior, by text alone, is then summed over groups of rows: by declared
markup language and by address suffix these sums say how far a declaration or a
suffix can be trusted, and by host, domain and over all rows they are priors,
each smoothed towards the next wider one.  A row's own share is taken out of its
host's prior.  Languages are ranked by

    log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host)

The trigram model is fitted on at most ``sample`` labelled texts of each language
(those with the smallest hash of their id); all group sums cover all rows.

Defined cases: missing evidence (null or empty text, no declaration, no address)
is left out; a row without any evidence is ``und`` with confidence 0; equal scores
go to the language first in order; repeated rows count as often as they come; an
empty table gives an empty table; without labelled texts every row is ``und``;
further columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, unit

BUCKETS = 1 << 15
CHUNK = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray              # log-likelihood by bucket and language


@dataclass(frozen=True)
class Fusion:
    sample: int = 1500             # labelled texts of each language
    languages: int = 128           # languages, the most frequent ones
    temper: float = 0.3            # overlapping trigrams are not independent
    weight: float = 10.0           # rows that a wider group counts for in a narrower one


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the trigrams of the lower-cased text, with a space before and after."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, max(1, len(codes) - 2), CHUNK):
        c = codes[at:at + CHUNK + 2]
        h = (c[:-2] * np.uint32(0x9E3779B1) ^ c[1:-1] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D) ^ c[2:] * np.uint32(0x27D4EB2F)
        yield ((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int64)


def fit(labelled: DataFrame) -> LanguageModel:
    """Fit the trigram model on (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for h in trigrams(text or ""):
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    sums[lang] += np.bincount(h, minlength=BUCKETS)
        for lang, s in sums.items():
            used = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(s[used])],
                                             names=["lang", "bucket", "n"])

    # at most one row per bucket and language
    counts = (labelled.select("text", "lang").mapInArrow(run, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((BUCKETS, len(languages)))
    for k, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        table[own["bucket"].to_numpy(np.int64), k] = own["n"].to_numpy()
    table = np.log((table + 0.1) / (table.sum(axis=0, keepdims=True) + 0.1 * BUCKETS)) if languages else table
    return LanguageModel(languages, table.astype(np.float32))


def labelled_sample(documents: DataFrame, fusion: Fusion) -> DataFrame:
    """At most ``sample`` texts of each language; the ids that pick them are bounded."""
    known = documents.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # a language's share of rows with the smallest draws is about twice the sample; only those are ranked
    most = F.broadcast(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(fusion.languages))
    draw = unit(F.col("doc_id"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "doc_id"))
    chosen = (known.select("doc_id", "lang").join(most, "lang").where(draw * F.col("count") <= 2 * fusion.sample + 50)
              .withColumn("rank", rank).where(F.col("rank") <= fusion.sample).select("doc_id", "lang").distinct())
    return documents.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("text", "lang")


def score_texts(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """``rows`` with ``text`` replaced by n_chars and scores, the text's log-likelihoods."""
    keep = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["n_chars long", "scores array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                texts = b.column(b.schema.get_field_index("text")).to_pylist()
                scores = np.zeros((len(texts), len(model.languages)))
                for k, text in enumerate(texts):
                    if text and text.strip():
                        for h in trigrams(text):
                            scores[k] += model.table[h].sum(axis=0, dtype=np.float64)
                offsets = np.arange(0, scores.size + 1, max(1, scores.shape[1]), dtype=np.int32)[:len(texts) + 1]
                if not scores.shape[1]:
                    offsets = np.zeros(len(texts) + 1, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index(n)) for n in names]
                    + [pa.array([len(t) if t and t.strip() else 0 for t in texts], pa.int64()),
                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))], names=[*names, "n_chars", "scores"])

    return rows.select(*names, "text").mapInArrow(run, schema)


def _normal(scores: Column) -> Column:
    """Probabilities from log scores."""
    return let(F.transform(scores, lambda s: F.exp(s - F.array_max(scores))), lambda e: F.transform(
        e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))


def fuse(rows: DataFrame, model: LanguageModel, fusion: Fusion = Fusion()) -> DataFrame:
    """``rows``: key columns, text, declared, suffix, domain, host.  Returns the key
    columns with lang, confidence, text_lang, n_chars."""
    n = len(model.languages)
    evidence = ("text", "declared", "suffix", "domain", "host")
    key = [c for c in rows.columns if c not in evidence]
    scored = cut(score_texts(rows, model), "scored")
    text = F.transform("scores", lambda s: s * fusion.temper)
    if not n:
        return scored.select(*key, F.lit("und").alias("lang"), F.lit(0.0).alias("confidence"),
                             F.lit(None).cast("string").alias("text_lang"), "n_chars")
    scored = scored.withColumn("scores", text).withColumn("p", _normal(F.col("scores")))
    told = scored.where("n_chars > 0")

    def sums(by: list[str], name: str, of: DataFrame, col: str = "p") -> DataFrame:
        return of.groupBy(*by).agg(*[F.sum(F.get(col, F.lit(k))).alias(f"_{k}") for k in range(n)]).select(
            *by, F.array(*[F.coalesce(f"_{k}", F.lit(0.0)) for k in range(n)]).alias(name))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    # counts by host are summed on to wider groups, rows are read once
    groups = cut(sums(["declared", "suffix", "domain", "host"], "c", told), "groups")
    every = groups.agg(*[F.sum(F.get("c", F.lit(k))) for k in range(n)]).first()
    every = [x or 0.0 for x in every]
    overall = [(x + 1.0) / (sum(every) + n) for x in every]

    def likelihood(name: str) -> DataFrame:
        """log P(value | language), smoothed by the value's share over all languages."""
        table = sums([name], "c", groups.where(F.col(name).isNotNull()), "c")
        all_rows = table.agg(*[F.sum(F.get("c", F.lit(k))) for k in range(n)]).first()
        base = [x or 0.0 for x in all_rows]
        share = total(F.col("c")) / max(sum(base), 1e-12)
        return table.select(name, F.array(*[F.log((F.get("c", F.lit(k)) + fusion.weight * share + 1e-9) / (base[k] + fusion.weight + 1e-9))
                                            for k in range(n)]).alias(f"{name}_log"))

    domains = sums(["domain"], "d", groups.where("domain is not null"), "c").select("domain", F.array(*[
        (F.get("d", F.lit(k)) + fusion.weight * overall[k]) / (total(F.col("d")) + fusion.weight) for k in range(n)]).alias("wider"))
    hosts = sums(["domain", "host"], "h", groups.where("host is not null"), "c").join(domains, "domain", "left")
    hosts = hosts.select("domain", "host", "h", "wider")
    joined = (scored.join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")
              .join(hosts, ["domain", "host"], "left"))
    own = F.when(F.col("n_chars") > 0, F.col("p"))

    def score(k: int) -> Column:
        mine = F.coalesce(F.get(own, F.lit(k)), F.lit(0.0))
        before = F.greatest(F.get("h", F.lit(k)) - mine, F.lit(0.0))
        rows_before = F.greatest(total(F.col("h")) - F.when(F.col("n_chars") > 0, 1.0).otherwise(0.0), F.lit(0.0))
        prior = (before + fusion.weight * F.coalesce(F.get("wider", F.lit(k)), F.lit(overall[k]))) / (rows_before + fusion.weight)
        return (F.get("scores", F.lit(k)) + F.coalesce(F.get("declared_log", F.lit(k)), F.lit(0.0))
                + F.coalesce(F.get("suffix_log", F.lit(k)), F.lit(0.0)) + F.log(F.coalesce(prior, F.lit(overall[k]))))

    names = F.array(*[F.lit(x) for x in model.languages])
    best = lambda p: F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int"))
    out = joined.withColumn("post", _normal(F.array(*[score(k) for k in range(n)])))
    some = (F.col("n_chars") > 0) | F.col("declared_log").isNotNull() | F.col("suffix_log").isNotNull() | F.col("h").isNotNull()
    return out.select(*key, F.when(some, best(F.col("post"))).otherwise("und").alias("lang"),
                      F.when(some, F.array_max("post")).otherwise(0.0).alias("confidence"),
                      F.when(F.col("n_chars") > 0, best(F.col("p"))).alias("text_lang"), "n_chars")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Visible text, declared language and address parts of (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    visible = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    filled = lambda c: F.when(c != "", c)
    rows = pages.select("page_id", visible.alias("text"), filled(declared).alias("declared"), filled(host).alias("host"))
    labels = F.split("host", r"\.")
    return rows.select(F.lit(None).cast("long").alias("doc_id"), "page_id", "text", "declared",
                       F.element_at(labels, -1).alias("suffix"), F.array_join(F.slice(
                           labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"), "host")


def document_evidence(documents: DataFrame) -> DataFrame:
    """Documents come without markup and address; their source stands for the host."""
    none = F.lit(None).cast("string")
    return documents.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", none.alias("declared"),
                            none.alias("suffix"), F.lit("").alias("domain"), F.col("source").alias("host"))


def identify(documents: DataFrame, pages: DataFrame, fusion: Fusion = Fusion()) -> DataFrame:
    """Languages of all documents (doc_id) and pages (page_id)."""
    model = fit(labelled_sample(documents, fusion))
    return fuse(document_evidence(documents).unionByName(page_evidence(pages)), model, fusion)
