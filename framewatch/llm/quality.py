"""Quality rules: plain text statistics and a hashed n-gram log-likelihood ratio.

Word unigrams and bigrams are hashed into buckets, a power of two that follows the
size of the target.  Two multinomials are estimated: one of the raw corpus (every
n-gram of every document) and one of a trusted target.  A document's score is the
mean, over its n-grams, of log p_target - log p_raw; it is kept when it passes the
base rules and its score reaches the threshold.  No document is drawn at random.

Nothing in the verdict depends on the size of the corpus: the target is mixed with
the raw multinomial in a fixed proportion, a trusted document's own n-grams are taken
out of the target that scores it, and the threshold is a stated quantile of these
scores over the trusted documents that pass the base rules.  So about that share of
documents like the trusted ones fails.  (The raw counts, which are those of all
documents, hold each document's own ones.)

The trusted target is fitted on every document with a trusted label, and the threshold
is taken over all of their scores; the corpus counts cover all documents.  No text is
shuffled to tell the trusted ones: a table of bits of bounded size holds all trusted ids,
and the few other ids of the corpus that it holds, too, are found by a join of ids and
joined to the texts in the way Spark chooses by their number.  A trusted document's statistics
and n-grams are made once, its n-grams are written as numbers and scored inside its own row;
what reaches the driver is a few counts, the bits, and a thousand counts at a time while the
threshold is narrowed down.

Defined cases: null text has no words; a document with fewer than 50 words fails
the base rules; with no trusted documents, or a target of one text alone, scores are 0;
with no trusted document that passes the base rules only these decide; repeated rows are
counted and returned as often as they come; equal scores get equal verdicts; an empty table
gives an empty table; further columns are carried along in the row, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, words

#: Scores are rounded to so many digits, so that the order of a sum decides nothing.
DIGITS = 9

#: The table of bits: so many for an id, about (a power of two in all), up to a size of 8 MB;
#: each id sets DRAWS of them.  Above that size more ids are taken for trusted ones and told apart by join.
BITS_AN_ID, MOST_BITS, DRAWS = 16, 1 << 26, 6

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRules:
    min_buckets: int = 1 << 12      # both are powers of two
    max_buckets: int = 1 << 17
    grams_a_bucket: int = 4         # n-grams of the target, about, for each bucket between the two
    mixed: float = 0.1              # raw multinomial added to the target, as a share of the target's n-grams
    quantile: float = 0.02          # of the trusted documents' scores: the threshold
    min_words: int = 50
    max_repeat_percent: int = 50


def repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    The hashes of the windows are sorted with their places; equal neighbours
    are repeats, and the union of the places they cover is measured."""
    def measure(s: Column) -> Column:
        repeated = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(starts, zero, lambda a, i: F.struct(
            (i + 3).alias("end"), (a["n"] + 3 - F.greatest(F.lit(0), a["end"] - i)).alias("n")),
            lambda a: a["n"])

    def windows(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def hashes(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    # most texts repeat nothing, and their windows are not sorted
    return let(w, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(windows(h), measure)))))


def n_grams(w: Column, buckets: int) -> Column:
    """Buckets of all unigrams and bigrams of a word array."""
    def bucket(*x: Column) -> Column:
        return F.pmod(F.xxhash64(*x), F.lit(buckets)).cast("int")
    return let(w, lambda w: F.concat(
        F.transform(w, lambda x: bucket(x)),
        F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: bucket(F.get(w, i), x))))


def base_statistics(documents: DataFrame) -> DataFrame:
    """The base statistics of every document, with its words and the whole row as ``row``."""
    return statistics(documents.select(F.struct("*").alias("row"), "text"))


def statistics(rows: DataFrame, *more: str) -> DataFrame:
    """The base statistics of (row, text) and the further columns ``more``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.select("row", *more, "text", words(F.col("text")).alias("words"), lines.alias("lines"))
    return rows.select(
        "row", *more, "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of every document with a trusted label."""
    return (labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
            .select("doc_id").distinct())


def bits_of(ids: DataFrame, most_bits: int) -> Callable[[Column], Column]:
    """Whether an id may be among ``ids``: true for each of them, and for few others."""
    bits = min(most_bits, max(64, 1 << (BITS_AN_ID * ids.count()).bit_length()))

    def places(x: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(k), x.cast("string")), F.lit(bits)) for k in range(DRAWS)]

    one = ids.select(F.explode(F.array(*places(F.col("doc_id")))).alias("place")).select(
        F.shiftright("place", 6).alias("at"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("word"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    table = one.unionByName(every).groupBy("at").agg(F.bit_or("word").alias("word"))
    table = cut(table.agg(F.sort_array(F.collect_list(F.struct("at", "word")))["word"].alias("t")), "quality-bits").scalar()
    return lambda x: x.isNotNull() & reduce(lambda a, b: a & b, [
        F.getbit(F.get(table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1 for p in places(x)])


def tell_trusted(documents: DataFrame, trusted: DataFrame, most_bits: int = MOST_BITS) -> Callable[[DataFrame], DataFrame]:
    """What adds to rows with a ``doc_id`` of ``documents`` the column ``trusted``, without a shuffle of the rows
    (unless the bits are far too few for the ids)."""
    among = bits_of(trusted, most_bits)
    wrong = documents.select("doc_id").where(among(F.col("doc_id"))).distinct().join(trusted, "doc_id", "left_anti")
    wrong = cut(wrong, "quality-wrong").select(F.col("doc_id").alias("_wrong"))
    return lambda rows: rows.join(wrong, F.col("doc_id") == F.col("_wrong"), "left").withColumn(
        "trusted", among(F.col("doc_id")) & F.col("_wrong").isNull()).drop("_wrong")


def bucket_count(target_words: int, rules: QualityRules) -> int:
    """Smallest power of two with a bucket for every ``grams_a_bucket`` n-grams, inside the limits."""
    wanted = 2 * target_words // rules.grams_a_bucket
    return min(rules.max_buckets, max(rules.min_buckets, 1 << max(wanted - 1, 0).bit_length()))


def bucket_counts(others: DataFrame, known: DataFrame, buckets: int) -> DataFrame:
    """bucket, raw, target: n-grams of all documents and of the trusted ones (``known``, with their ``grams``)."""
    counts = [rows.select(F.explode(grams).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", F.col("n").alias("raw"), (F.col("n") * trusted).alias("target")) for rows, grams, trusted in (
        (others, n_grams(words(F.col("text")), buckets), 0), (known, folded("grams", buckets), 1))]
    every = others.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("raw"), F.lit(0).alias("target"))
    return every.unionByName(counts[0]).unionByName(counts[1]).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def folded(grams: str, buckets: int) -> Column:
    """Buckets among ``buckets`` from those among a larger power of two."""
    return F.transform(grams, lambda x: F.pmod(x, F.lit(buckets)))


@dataclass(frozen=True)
class Multinomials:
    """Totals of the bucket counts, which are rows or arrays on Spark's side."""
    n_raw: int
    n_target: int
    buckets: int
    rules: QualityRules

    def parts(self, raw: Column, target: Column) -> dict[str, Column]:
        """What a bucket's ratio needs whatever its document: its target count, its mixed share, log p_raw (and the mix)."""
        p = (raw + 1) / F.lit(float(self.n_raw + self.buckets))
        return {"target": target.cast("double"), "mixed": F.lit(self.rules.mixed) * p, "log": F.log(F.lit(1 + self.rules.mixed) * p)}

    def ratio(self, part: Column, own: Column, n: Column) -> Column:
        """log p_target - log p_raw of a bucket by a target of ``n`` n-grams, which is without ``own`` of those here."""
        return F.log((part["target"] - own) / n + part["mixed"]) - part["log"]


def trusted_scores(known: DataFrame, counts: DataFrame, model: Multinomials) -> DataFrame:
    """doc_id, h, statistics, base_failed, own_score of the trusted texts, each by the target without it
    (null without words).  A text's buckets are sorted, and each run of equal ones is weighed by what the others leave there."""
    parts = F.struct("bucket", *[v.alias(k) for k, v in model.parts(F.col("raw"), F.col("target")).items()])
    table = cut(counts.agg(F.sort_array(F.collect_list(parts)).alias("t")), "quality-table").scalar()

    def score(t: Column, n: Column, g: Column) -> Column:
        def run(first: Column, end: Column) -> Column:
            part, own = F.get(t, F.get(g, first)), (end - first).cast("double")
            return own * model.ratio(part, own, n)
        # where runs begin, and the end
        starts = F.filter(F.sequence(F.lit(0), F.size(g)), lambda i: F.coalesce(F.get(g, i) != F.get(g, i - 1), F.lit(True)))
        return let(starts, lambda p: F.round(F.aggregate(
            F.sequence(F.lit(1), F.size(p) - 1), F.lit(0.0), lambda a, k: a + run(F.get(p, k - 1), F.get(p, k))) / F.size(g), DIGITS))

    # the table is named once, so it moves into the score and is not copied into every row
    n_left = (F.lit(model.n_target) - F.size("grams")).cast("double")
    own = let(F.col("_t"), lambda t: let(n_left, lambda n: F.when(n > 0, let(
        F.sort_array(folded("grams", model.buckets)), lambda g: score(t, n, g))).otherwise(0.0)))
    rows = known.select("*", table.alias("_t"))
    return rows.select("doc_id", "h", *STATISTICS, "base_failed", F.when(F.size("grams") > 0, own).alias("own_score")).dropDuplicates(["doc_id", "h"])


def exact_quantile(values: DataFrame, q: float) -> float | None:
    """The interpolated quantile of the column ``x`` of numbers with ``DIGITS`` decimals; None without rows.
    The one or two values around its place are narrowed down by their leading bits, a
    thousand counts at a time, so no task and no driver holds the values."""
    n = values.count()
    if not n:
        return None
    at = q * (n - 1)
    scaled = values.select(F.round(F.col("x") * 10 ** DIGITS).cast("long").alias("x"))
    found = {rank: (0, rank) for rank in (math.floor(at), math.ceil(at))}   # leading bits so far, rank among values with them
    for shift in (60, 50, 40, 30, 20, 10, 0):
        part = scaled if shift == 60 else scaled.where(F.shiftright("x", shift + 10).isin([p for p, _ in found.values()]))
        counts = sorted((r["p"], r["n"]) for r in part.groupBy(F.shiftright("x", shift).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        for rank, (above, left) in found.items():
            for p, c in counts:
                if shift < 60 and p >> 10 != above:
                    continue
                if left < c:
                    found[rank] = (p, left)
                    break
                left -= c
    low, high = (found[rank][0] / 10 ** DIGITS for rank in (math.floor(at), math.ceil(at)))
    return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def quality_rules(documents: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``row`` (the whole row as it came), base statistics, base_failed, score (null
    without words), kept."""
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    tell = tell_trusted(documents, cut(trusted_ids(labels), "quality-trusted"))
    texts = tell(documents.select("doc_id", "text"))
    known = cut(base_statistics(texts.where("trusted").drop("trusted")).select(
        F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("h"),
        n_grams(F.col("words"), rules.max_buckets).alias("grams"), *STATISTICS, failed.alias("base_failed")), "quality-known")
    # three numbers to the driver
    buckets = bucket_count(known.select("doc_id", "h", "n_words").distinct().agg(F.sum("n_words").alias("n")).first()["n"] or 0, rules)
    counts = cut(bucket_counts(texts.where("not trusted"), known, buckets), "quality-counts")
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    model = Multinomials(totals["raw"], totals["target"], buckets, rules)
    of_trusted = cut(trusted_scores(known, counts, model), "quality-scores")
    threshold = exact_quantile(of_trusted.where("not base_failed and own_score is not null").select(F.col("own_score").alias("x")), rules.quantile)

    # one array of the size of the buckets
    part = F.struct(*[v.alias(k) for k, v in model.parts(F.col("raw"), F.col("target")).items()])
    ratio = model.ratio(part, F.lit(0), F.lit(float(model.n_target))) if model.n_target else F.lit(0.0)
    ratio = F.struct("bucket", ratio.alias("ratio"))
    ratios = cut(counts.agg(F.sort_array(F.collect_list(ratio))["ratio"].alias("ratio")), "quality-ratios").scalar()
    rows = tell(documents.select(F.struct("*").alias("row"), "doc_id", "text"))
    others = statistics(rows.where("not trusted")).select("*", failed.alias("base_failed"))
    # named once and above a join, the array moves into the score and is not copied into every row
    score = let(F.col("_ratios"), lambda r: let(n_grams(F.col("words"), buckets), lambda g: F.when(F.size(g) > 0, F.round(
        F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get(r, b)) / F.size(g), DIGITS))))
    found = ["row", *STATISTICS, "base_failed"]
    others = others.select("*", ratios.alias("_ratios")).select(*found, score.alias("score"))
    # the trusted ones are looked up: of their texts only what a reader of ``row`` asks for is moved
    own = of_trusted.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    known = rows.where("trusted").select("row", "doc_id", F.xxhash64("text").alias("h")).join(
        own, (F.col("doc_id") == F.col("_id")) & (F.col("h") == F.col("_h"))).select(*found, F.col("own_score").alias("score"))
    return others.unionByName(known).select("*", (~F.col("base_failed") & (
        F.col("score") >= F.lit(float("-inf") if threshold is None else threshold))).alias("kept"))
