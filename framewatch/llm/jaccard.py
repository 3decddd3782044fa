"""Exact Jaccard self-join of word n-gram sets, skipping work by set relations.

A document's set holds the distinct k-word shingles of its lower-cased text.
Two documents link when the Jaccard similarity of their sets reaches the
threshold; the components of these links are returned.

1. Equal sets are one class (a digest of the set); one of each class goes on.
2. Shingles are put in one fixed order, rare ones first.  Frequencies come from a
   table of 65,536 counters summed over the corpus, so no shingle is shuffled to
   count it, and the table broadcast to sort them has a fixed size.  Two sets
   that reach the threshold have SHARED shingles in common among their first
   ones (the prefix, made longer for that); pairs with fewer are not compared.
3. In the index list of every shingle one set, the one with the shingle earliest
   in its order, is compared with the others of the list that may reach the
   threshold.  Sets found to be linked are in one component, and pairs inside a
   component need no comparison.
4. Block skipping.  Lists that still hold several components are cut into blocks
   by set size, by the shingle's position and by a bounded number of entries; a
   pair of blocks is skipped whole when the sizes are too far apart, when what
   follows the positions is too short to reach the threshold, or when all its
   sets are of one component.  Pairs of the rest are compared exactly.
5. Answers of similar sets.  Lists with very many such pairs hold sets of much the
   same text.  Each of these sets is compared with one in their middle; the
   overlap of two of them then follows from their small differences to it, and is
   computed in tiles that return at most one row for each of their sets.

Shingles are 64-bit hashes (of the words' xxh64), as exact as that: two
different shingles of two compared texts collide with chance about 1e-13.

Defined cases: null text, or text without words, has an empty set and links with
nothing; fewer words than k make one shingle of all of them; rows with a null
doc_id come back with a null component and link with nothing; a node is a set, so texts that
differ under one doc_id are nodes of their own and each keeps its links (its rows may then
have unlike components); an empty table gives an empty table; further columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut
from .components import components, reach

COUNTERS = 1 << 16
SHARED = 3     # shingles two sets must have in common among their first ones
IDS_SENT = 200_000   # ids up to which texts are looked up by a broadcast, by join beyond
BLOCK = 64     # sets in a block of an index list, on average
TILE = 512     # sets of a crowd compared at once
DENSE = 8      # open pairs for each set of a list, from which differences are used


@dataclass(frozen=True)
class Similarity:
    words: int = 5
    percent: int = 80      # link when 100 * intersection >= percent * union

    def overlap(self, sizes: Column) -> Column:
        """The least intersection that two sets of these sizes together need."""
        return F.ceil(sizes * self.percent / (100 + self.percent))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text.  ``bytes.lower`` and
    ``bytes.split`` know ASCII letters and ASCII white space only."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    width = min(k, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    # a short text's one shingle differs from any k-word shingle
    return np.unique((total + np.uint64(k - width)).view(np.int64))


def _texts(batches: Iterator) -> Iterator[list[list]]:
    for big in batches:
        for at in range(0, big.num_rows, 64):
            batch = big.slice(at, 64)
            yield [c.to_pylist() for c in batch.columns]


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def read_sets(documents: DataFrame, sim: Similarity) -> DataFrame:
    """Rows of documents (doc_id, h, n, digest; h: a hash of the text), then rows of counters (bucket, count)."""
    def run(batches: Iterator) -> Iterator:
        counts = np.zeros(COUNTERS, np.int64)
        for ids, texts, hashes in _texts(batches):
            sets = [shingles(t, sim.words) for t in texts]
            if sets:
                counts += np.bincount((np.concatenate(sets) & (COUNTERS - 1)), minlength=COUNTERS)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
                pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int64())], names=names)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()),
            pa.array(used.astype(np.int32)), pa.array(counts[used])], names=names)

    names = ["doc_id", "h", "n", "digest", "bucket", "count"]
    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, h long, n long, digest binary, bucket int, count long")


def read_prefixes(documents: DataFrame, sim: Similarity, counts: np.ndarray) -> DataFrame:
    """doc_id, digest, n, and the first shingles of every set in the order of the counters."""
    def run(batches: Iterator) -> Iterator:
        for ids, texts in _texts(batches):
            sizes, firsts, digests = [], [], []
            for t in texts:
                s = shingles(t, sim.words)
                digests.append(_digest(s))
                keep = len(s) - -(-len(s) * sim.percent // 100) + SHARED if len(s) else 0
                firsts.append(s[np.lexsort((s, counts[s & (COUNTERS - 1)]))[:keep]])
                sizes.append(len(s))
            offsets = np.cumsum([0] + [len(f) for f in firsts]).astype(np.int32)
            values = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "digest", "n", "prefix"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, digest binary, n long, prefix array<long>")


def whole_sets(documents: DataFrame, sim: Similarity) -> DataFrame:
    """doc_id, digest and the whole set."""
    def run(batches: Iterator) -> Iterator:
        for ids, texts in _texts(batches):
            sets = [shingles(t, sim.words) for t in texts]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "digest", "set"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, digest binary, set binary")


@F.pandas_udf(T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("dropped", "added")]))
def difference(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """What b lacks of a, and has besides; null where that is over half of either set."""
    dropped, added = [], []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
        d, e = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
        near = 2 * max(len(d), len(e)) <= min(len(x), len(y))
        dropped.append(d if near else None)
        added.append(e if near else None)
    return pd.DataFrame({"dropped": dropped, "added": added})


@F.pandas_udf(T.LongType())
def common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the intersection of two sets of sorted distinct longs."""
    out = []
    for x, y in zip(a, b, strict=True):
        both = np.concatenate((np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)))
        both.sort(kind="stable")
        out.append(int(np.count_nonzero(both[1:] == both[:-1])))
    return pd.Series(out, dtype="int64")


def compare(pairs: DataFrame, documents: DataFrame, classes: DataFrame, sim: Similarity, name: str, differ: bool = False) -> DataFrame:
    """pairs (a, b, na, nb) of keys of ``classes``: written with ``both``, the size of their intersection,
    or with what b lacks of a and has besides.

    Only texts that stand in a pair are read into sets; b's set travels once for
    each of its pairs, a's set is looked up in place."""
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    needed = cut(needed.join(classes, "id").select("id", "doc_id", "digest"), f"{name}-ids")
    ids = needed.select("doc_id")
    if needed.count() <= IDS_SENT:
        ids = F.broadcast(ids)
    # a set is that of its class's smallest doc_id; other texts under this id have other digests
    sets = whole_sets(documents.select("doc_id", "text").join(ids, "doc_id", "left_semi"), sim)
    sets = cut(sets.join(needed, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"]).select("id", "set"), f"{name}-sets")
    joined = (pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
              .join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a"))
    made = [F.col("d.dropped"), F.col("d.added")] if differ else ["both"]
    udf = difference("sa", "sb").alias("d") if differ else common("sa", "sb").alias("both")
    return cut(joined.select("a", "b", "na", "nb", udf).select("a", "b", "na", "nb", *made), f"{name}-compared")


def _may_reach(n1: Column, p1: Column, n2: Column, p2: Column, sim: Similarity) -> Column:
    """Sizes close enough, and enough shingles at or before and from the positions on."""
    return ((100 * F.least(n1, n2) >= sim.percent * F.greatest(n1, n2))
            & (F.least(p1, p2) + F.least(n1 - p1, n2 - p2) >= sim.overlap(n1 + n2)))


def _reaches(both: Column, n1: Column, n2: Column, sim: Similarity) -> Column:
    return (100 + sim.percent) * both >= sim.percent * (n1 + n2)


def _often(pairs: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs (a, b, na, nb), one row for each list they share, once each: those that
    share as many lists as a pair that reaches the threshold does."""
    return (pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("shared"))
            .where(F.col("shared") >= F.least(F.lit(SHARED), sim.overlap(F.col("na") + F.col("nb")))).drop("shared"))


def _open(p: Column, q: Column, sim: Similarity) -> Column:
    """Two sets of a list that are not known to be connected and may reach the threshold."""
    return (p["component_id"] != q["component_id"]) & _may_reach(p["n"], p["pos"], q["n"], q["pos"], sim)


def linked_by_difference(x: list, y: list, middle: int, sim: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all linked pairs of two lists of sets (size, dropped, added), given by
    their differences to one set m of size ``middle``:
    |x & y| = |m| - |m-x| - |m-y| + |(m-x) & (m-y)| + |(x-m) & (y-m)|."""
    n_x, n_y = (np.array([s[0] for s in side], np.int64) for side in (x, y))
    both = middle - np.array([len(s[1]) for s in x])[:, None] - np.array([len(s[1]) for s in y])[None, :]
    for part in (1, 2):
        tokens = [np.concatenate([np.asarray(s[part], np.int64) for s in side] or [np.empty(0, np.int64)]) for side in (x, y)]
        rows = [np.repeat(np.arange(len(side)), [len(s[part]) for s in side]) for side in (x, y)]
        shared = np.intersect1d(tokens[0], tokens[1])
        for at in range(0, len(shared), 4096):
            some = shared[at:at + 4096]
            marks = []
            for t, r, side in zip(tokens, rows, (x, y), strict=True):
                place = np.minimum(np.searchsorted(some, t), len(some) - 1)
                hit = some[place] == t
                m = np.zeros((len(side), len(some)), np.float32)
                m[r[hit], place[hit]] = 1
                marks.append(m)
            both = both + np.rint(marks[0] @ marks[1].T).astype(np.int64)
    return np.nonzero((100 + sim.percent) * both >= sim.percent * (n_x[:, None] + n_y[None, :]))


def _links_by_difference(differ: DataFrame, sim: Similarity) -> DataFrame:
    """Links (a, b) that connect all linked sets of each crowd, from the differences
    (a: the crowd's middle, na, b, nb, dropped, added).  A crowd is cut into tiles of
    bounded size; a pair of tiles gives at most one row for each of its sets."""
    counts = differ.groupBy("a").agg(F.count(F.lit(1)).alias("crowd"))
    tiles = differ.join(counts, "a").groupBy(
        "a", "na", F.pmod(F.xxhash64("b"), F.ceil(F.col("crowd") / TILE)).alias("tile")).agg(
        F.collect_list(F.struct("b", "nb", "dropped", "added")).alias("sets"))
    tiles = cut(tiles, "tiles")
    x = tiles.select("a", "na", F.col("tile").alias("tx"), F.col("sets").alias("xs"))
    y = tiles.select("a", F.col("tile").alias("ty"), F.col("sets").alias("ys"))
    work = x.join(y, "a").where("tx <= ty").repartition(F.xxhash64("a", "tx", "ty"))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for k in range(batch.num_rows):
                middle, xs, ys = (batch.column(c)[k].as_py() for c in range(3))
                i, j = linked_by_difference(*[[(s["nb"], s["dropped"], s["added"]) for s in side] for side in (xs, ys)], middle, sim)
                ids = np.array([s["b"] for s in xs] + [s["b"] for s in ys], np.int64)
                low = reach(len(ids), i, j + len(xs))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[low])], names=["a", "b"])

    return work.select("na", "xs", "ys").mapInArrow(run, "a long, b long").where("a <> b").distinct()


def _block_pairs(entries: DataFrame, fields: list[str], sim: Similarity) -> DataFrame:
    """Index lists as blocks by size, position and number; pairs of blocks of a list
    that cannot be skipped: token, df, ox, oy (which blocks), xs, ys (their sets)."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / sim.percent)))
    blocks = (entries.groupBy("token", "df", band.alias("band"), F.floor(F.log2(F.col("pos") + 1.0)).alias("depth"),
                              F.pmod(F.xxhash64("rep"), F.ceil(F.col("df") / BLOCK)).alias("part"))
              .agg(F.collect_list(F.struct(*fields)).alias("sets"), F.min("n").alias("n_min"), F.max("n").alias("n_max"),
                   F.min("pos").alias("pos_min"), F.max("pos").alias("pos_max"),
                   F.min("component_id").alias("c_min"), F.max("component_id").alias("c_max")))
    blocks = cut(blocks, "blocks")
    x, y = blocks.alias("x"), blocks.alias("y")
    # a block with sets down to position p has at most p shingles before them
    reach = F.least(F.col("x.pos_max"), F.col("y.pos_max")) + F.least(
        F.col("x.n_max") - F.col("x.pos_min"), F.col("y.n_max") - F.col("y.pos_min"))
    order = lambda s: F.struct(f"{s}.band", f"{s}.depth", f"{s}.part")
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("y.band") - F.col("x.band")).between(-1, 1)
                  & (order("x") <= order("y")) & (reach >= sim.overlap(F.col("x.n_min") + F.col("y.n_min")))
                  & ((F.col("x.c_min") != F.col("y.c_max")) | (F.col("x.c_max") != F.col("y.c_min")))).select(
        F.col("x.token").alias("token"), F.col("x.df").alias("df"), order("x").alias("ox"), order("y").alias("oy"),
        F.col("x.sets").alias("xs"), F.col("y.sets").alias("ys"))


def _pairs(blocks: DataFrame, keep) -> DataFrame:
    """The pairs (p, q) of sets of every pair of blocks for which ``keep`` holds."""
    return (blocks.select("ox", "oy", "ys", F.explode("xs").alias("p"))
            .select("p", F.explode(F.filter("ys", lambda q: keep(F.col("p"), q))).alias("q")))


def similar_rows(documents: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """doc_id, h (a hash of the text), n_shingles, component_id and, where a row has a set, node (its class)
    of every row of ``documents`` (doc_id, text)."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = cut(read_sets(documents, sim), "sets")
    rows = read.where(F.col("n").isNotNull()).select("doc_id", "h", "n", "digest")
    table = read.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("count").alias("count")).toPandas()
    counts = np.zeros(COUNTERS, np.int64)
    counts[table["bucket"].to_numpy(dtype=np.int64)] = table["count"].to_numpy(dtype=np.int64)

    # a class of equal sets is a node, with a number of its own
    linkable = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = cut(linkable.groupBy("digest", "n").agg(F.min("doc_id").alias("doc_id"))
                  .withColumn("id", F.monotonically_increasing_id()), "classes")

    # index lists of shingles that two sets or more have among their first ones
    firsts = classes.select("doc_id", "digest", F.col("id").alias("rep"))
    entries = (read_prefixes(documents, sim, counts).join(firsts, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
               .select("rep", "n", F.posexplode("prefix").alias("pos", "token")))
    entries = cut(entries, "entries")
    lists = (entries.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("pos", "n", "rep")).alias("first"))
             .where("df > 1"))
    entries = cut(entries.join(lists, "token"), "lists")

    def linked(d: DataFrame) -> DataFrame:
        return d.where(_reaches(F.col("both"), F.col("na"), F.col("nb"), sim))

    first = F.col("first")
    stars = entries.where((F.col("rep") != first["rep"]) & _may_reach(
        F.col("n"), F.col("pos"), first["n"], first["pos"], sim))
    stars = cut(_often(stars.select(first["rep"].alias("a"), F.col("rep").alias("b"), first["n"].alias("na"), F.col("n").alias("nb")),
                       sim), "stars")
    compared = compare(stars, documents, classes, sim, "stars")
    found = linked(compared).select("a", "b")
    known = components(found, "star")

    # what is left: lists with several components
    entries = entries.join(known.withColumnRenamed("id", "rep"), "rep", "left").select(
        "token", "df", "rep", "n", "pos", F.coalesce("component_id", "rep").alias("component_id"),
        first["rep"].alias("first_rep"))
    several = (entries.groupBy("token").agg(F.min("component_id").alias("x"), F.max("component_id").alias("y"))
               .where("x <> y").select("token"))
    rest = cut(entries.join(several, "token", "left_semi"), "rest")
    near = cut(_block_pairs(rest, ["rep", "n", "pos", "component_id"], sim), "near")
    is_open = lambda p, q: _open(p, q, sim) & ((F.col("ox") != F.col("oy")) | (p["rep"] < q["rep"]))

    # lists with many open pairs for their length: sets of much the same text,
    # known by what differs from one set in their middle
    open_pairs = F.aggregate("xs", F.lit(0).cast("long"), lambda n, p: n + F.size(F.filter("ys", lambda q: is_open(p, q))))
    dense = (near.groupBy("token").agg(F.sum(open_pairs).alias("open"), F.first("df").alias("df"))
             .where(F.col("open") > DENSE * F.col("df")).select("token"))
    dense = cut(dense, "dense")
    crowd = rest.join(dense, "token", "left_semi")
    cluster = components(crowd.select(F.col("rep").alias("a"), F.col("first_rep").alias("b")), "crowd")
    crowd = crowd.join(cluster.select(F.col("id").alias("rep"), F.col("component_id").alias("cluster")), "rep")
    member = crowd.groupBy("cluster", "rep", "n").agg(F.count(F.lit(1)).alias("lists"))
    middle = member.groupBy("cluster").agg(F.max(F.struct("lists", -F.col("rep"), "rep", "n")).alias("m")).select(
        "cluster", F.col("m.rep").alias("a"), F.col("m.n").alias("na"))
    differ = compare(cut(member.join(middle, "cluster").select("a", F.col("rep").alias("b"), "na", F.col("n").alias("nb")), "crowd"),
                     documents, classes, sim, "crowd", differ=True)
    known_by = differ.where("dropped is not null")
    more = _links_by_difference(known_by, sim)

    # of dense lists, what is left are pairs with a set unlike the middle one
    placed = known_by.select(F.col("b").alias("rep"), F.lit(True).alias("placed")).distinct()
    odd = rest.join(dense, "token", "left_semi").join(placed, "rep", "left").withColumn("placed", F.col("placed").isNotNull())
    odd = _pairs(_block_pairs(odd, ["rep", "n", "pos", "component_id", "placed"], sim),
                 lambda p, q: is_open(p, q) & ~(p["placed"] & q["placed"]))
    pairs = _pairs(near.join(dense, "token", "left_anti"), is_open).unionByName(odd.select(
        *[F.col(s).dropFields("placed").alias(s) for s in "pq"]))
    small, large = F.least("p.rep", "q.rep"), F.greatest("p.rep", "q.rep")
    pairs = _often(pairs.select(
        small.alias("a"), large.alias("b"), F.when(F.col("p.rep") == small, F.col("p.n")).otherwise(F.col("q.n")).alias("na"),
        F.when(F.col("p.rep") == small, F.col("q.n")).otherwise(F.col("p.n")).alias("nb")), sim)
    done = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = cut(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    more = more.unionByName(linked(compare(pairs, documents, classes, sim, "pairs")).select("a", "b"))

    member = components(known.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionByName(more), "all")
    # a component is named by its smallest doc_id
    nodes = classes.join(member, "id", "left").withColumn("node", F.coalesce("component_id", "id"))
    named = nodes.groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(named, "node").select("digest", F.col("n").alias("_n"), "node", "least")
    there = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return rows.join(nodes.withColumnRenamed("digest", "_digest"), there & (F.col("digest") == F.col("_digest")) & (F.col("n") == F.col("_n")), "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "node")


def similar_documents(documents: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``documents`` (doc_id, text)."""
    return similar_rows(documents, sim).select("doc_id", "n_shingles", "component_id")
