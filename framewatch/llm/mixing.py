"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target number of words.  All documents of a source start
with the same expected number of copies, target / source size; its whole part is
taken surely, and the fractions are rounded dependently: two documents are
paired, and words are moved from one to the other, in a random direction whose
probabilities keep both expectations, until one of the two fractions is 0 or 1.
The sum of the words never changes, so a source misses its target by at most half
of its last document.

Pairing follows a reduction tree: documents are dealt by hash into groups of
bounded size, each group is reduced to one document that is still fractional,
and these go to the next, smaller set of groups until one is left, which is
rounded to the nearer side.  All draws are hashes of the ids, so reruns agree
and a lost task gives the same result again.

Defined cases: null text has size 0, and a document of size 0 takes 0; null
sources form one source, last in order; rows that repeat an id are numbered and
drawn separately; an empty table gives an empty table; further columns of the
input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, unit, words


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (5, 2, 1)   # by order of the sources, repeating
    share: float = 1.5                     # of all words
    most: float = 2.0                      # times a source's words
    group: int = 64                        # documents reduced together, on average
    seed: int = 17


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per source: rows, source_size, target.

    Resharing the excess until no target is above its limit ends at
    min(limit, level * weight) with one common level, found from the limits in
    order of limit / weight.  The windows are over the table of sources, which
    holds one row each."""
    sources = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    k = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in mix.weights]), k % len(mix.weights))
    sources = sources.select("*", weight.alias("weight"), (F.col("source_size") * mix.most).alias("limit"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * mix.share
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    sources = sources.withColumn("level", level)
    sources = sources.withColumn("first", F.first(F.when(
        F.col("level") <= F.col("limit") / F.col("weight"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return sources.select("source", "n", "source_size", F.least(
        "limit", F.coalesce("first", F.lit(0.0)) * F.col("weight")).alias("target"))


def _reduce(items: Column) -> Column:
    """Reduce an array of fractional items to decisions and one rest (or none)."""
    item = "struct<doc_id:bigint,k:bigint,size:bigint,p:double,u:double>"
    taken = "array<struct<doc_id:bigint,k:bigint,size:bigint,copy:int>>"
    zero = F.struct(F.lit(None).cast(item).alias("rest"), F.array().cast(taken).alias("done"))

    def made(x: Column, copy: int) -> Column:
        return F.array(F.struct(x["doc_id"].alias("doc_id"), x["k"].alias("k"), x["size"].alias("size"), F.lit(copy).alias("copy")))

    def left(x: Column, p: Column) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["k"].alias("k"), x["size"].alias("size"),
                        p.alias("p"), x["u"].alias("u"))

    def pair(a: Column, x: Column) -> Column:
        r = a["rest"]
        none = F.lit(None).cast(item)

        def move(m: Column) -> Column:
            """gain words go to r with probability lose / (gain + lose), else lose words leave it."""
            def after(up: Column, down: Column, words: Column, full: Column, empty: Column) -> Column:
                # up gets the words of down: up is full, or down is empty, or both
                done = F.concat(a["done"], F.when(full, made(up, 1)).otherwise(F.array().cast(taken)),
                                F.when(empty, made(down, 0)).otherwise(F.array().cast(taken)))
                rest = (F.when(full & empty, none)
                        .when(full, left(down, F.greatest(F.lit(0.0), down["p"] - words / down["size"])))
                        .otherwise(left(up, F.least(F.lit(1.0), up["p"] + words / up["size"]))))
                return F.struct(rest.alias("rest"), done.alias("done"))
            gain, lose = m["gain"], m["lose"]
            return F.when(x["u"] * (gain + lose) < lose,
                          after(r, x, gain, m["r_room"] <= m["x_has"], m["x_has"] <= m["r_room"])
                          ).otherwise(after(x, r, lose, m["x_room"] <= m["r_has"], m["r_has"] <= m["x_room"]))

        r_room, r_has = r["size"] * (1 - r["p"]), r["size"] * r["p"]
        x_room, x_has = x["size"] * (1 - x["p"]), x["size"] * x["p"]
        m = F.struct(r_room.alias("r_room"), r_has.alias("r_has"), x_room.alias("x_room"), x_has.alias("x_has"),
                     F.least(r_room, x_has).alias("gain"), F.least(r_has, x_room).alias("lose"))
        return F.when(r.isNull(), F.struct(left(x, x["p"]).alias("rest"), a["done"].alias("done"))
                      ).otherwise(let(m, move))

    return F.aggregate(items, zero, pair)


def mix_sources(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``sizes`` has doc_id, source and size (long).  Returns a row for each of its
    rows: doc_id, source, size, k (number among equal rows), source_size, target, copies."""
    sizes = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
    sizes = cut(sizes.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("k")),
                "mix-sizes")
    targets = cut(source_targets(sizes, mix), "mix-targets")
    t = targets.select(F.col("source").alias("_source"), "n", "source_size", "target")
    rows = sizes.join(t, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.select("*", share.alias("share")).select(
        "*", F.floor("share").cast("int").alias("whole"), (F.col("share") - F.floor("share")).alias("p"))
    whole = rows.select("doc_id", "k", "source", "size", "source_size", "target", "whole")
    items = rows.where((F.col("p") > 0) & (F.col("size") > 0)).select("source", "n", "doc_id", "k", "size", "p")

    most = targets.agg(F.max("n")).first()[0] or 0
    parts, groups = [], most
    level = 0
    while True:
        level += 1
        groups = -(-groups // mix.group)
        dealt = F.ceil(F.col("n") / float(mix.group ** level)).cast("long")
        group = F.pmod(F.xxhash64(F.lit(mix.seed), F.lit(level), "doc_id", "k", "size"), F.greatest(dealt, F.lit(1)))
        draw = unit(F.lit(mix.seed), F.lit(-level), F.col("doc_id"), F.col("k"), F.col("size"))
        # large documents first: the small ones that follow settle them, so what is left is small
        order = F.struct((-F.col("size")).alias("s"), F.xxhash64(F.lit(mix.seed), "k", "doc_id").alias("h"))
        reduced = (items.withColumn("g", group).groupBy("source", "n", "g")
                   .agg(F.sort_array(F.collect_list(F.struct(
                       order.alias("o"), "doc_id", "k", "size", "p", draw.alias("u")))).alias("items"))
                   .select("source", "n", _reduce(F.transform("items", lambda x: x.dropFields("o"))).alias("r")))
        reduced = cut(reduced, f"mix-level{level}")
        parts.append(reduced.select("source", F.explode("r.done").alias("d")))
        rest = reduced.where(F.col("r.rest").isNotNull()).select("source", "n", "r.rest.*")
        if groups <= 1:
            break
        items = rest.drop("u")
    last = rest.select("source", F.struct("doc_id", "k", "size", (F.col("p") >= 0.5).cast("int").alias("copy")).alias("d"))
    decided = last
    for p in parts:
        decided = decided.unionByName(p)
    decided = decided.select(F.col("source").alias("_source"), F.col("d.doc_id").alias("_doc"),
                             F.col("d.k").alias("_k"), F.col("d.size").alias("_size"), F.col("d.copy").alias("copy"))
    return (whole.join(decided, (F.col("doc_id").eqNullSafe(F.col("_doc"))) & (F.col("k") == F.col("_k"))
                       & (F.col("size") == F.col("_size")) & F.col("source").eqNullSafe(F.col("_source")), "left")
            .select("doc_id", "source", "size", "k", "source_size", "target",
                    (F.col("whole") + F.coalesce("copy", F.lit(0))).cast("int").alias("copies")))


def word_sizes(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))


def mixed(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document."""
    return mix_sources(word_sizes(documents), mix).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
