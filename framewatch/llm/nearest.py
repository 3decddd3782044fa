"""Approximate nearest neighbours by few stable projections, a kd-tree and a chi-square stop.

Unit vectors are projected onto ``axes`` Gaussian directions.  The Gaussian law is
2-stable, so for two vectors at distance r the squared projected distance is r * r
times a chi-square variable with ``axes`` degrees of freedom.  The projections are
indexed by a kd-tree: its top is fitted on a bounded sample and deals every vector into a
cell; the vectors of a cell are written in tiles, each a kd-tree of its own with leaves of
``leaf`` vectors.  A query takes projected neighbours leaf by leaf, nearest box first,
and computes the cosine of the original vectors for those within reach.  It stops when
the next box is farther than r_k * sqrt(x), r_k the distance of the k-th best so far and x
the quantile of the chi-square law at ``confidence``: a vector nearer than r_k lies
beyond with probability 1 - confidence at most, which is the expected loss of recall.

The search runs in two joins.  First each query searches its own cell, which bounds r_k.
Then the stopping radius is known, and chunks of queries go only to those cells whose box it
reaches; the stop is applied again in every tile.  Vectors that are equal are one point
of the index with their k + 1 smallest ids, so very large groups of copies cost one.
Index and chunks are written tables: a lost task reads them again.

Bounds: the sample is ``sample`` vectors on average (all, if there are fewer); there are
at most sample / 16 cells, whose boxes are sent to the tasks; ``lengths`` most frequent
vector lengths have cells, vectors of other lengths are one cell a length (in tiles).
Everything is indexed, nothing is capped in the search.

Defined cases: rows with a null vec_id, or a vector that is null, empty, zero or
holds null or non-finite elements, take no part.  Vectors of different lengths are not
compared.  A query that is repeated as a row is answered once; its other row is a
candidate like any row.  With fewer than k candidates all are returned; with none the query has
no row.  An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .embed_dedup import linkable

NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Nearest:
    k: int = 5
    every: int = 50            # queries are the rows whose vec_id it divides
    axes: int = 10             # stable projections, an even number
    confidence: float = 0.98   # of the stopping test
    sample: int = 1 << 17      # vectors that the top of the tree is fitted on
    cell: int = 8192           # vectors in a cell, about, while cells suffice
    tile: int = 1024           # vectors in a tile
    leaf: int = 64             # vectors in a leaf
    chunk: int = 256           # queries in a chunk
    lengths: int = 64          # vector lengths with cells of their own
    seed: int = 11


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square of m degrees <= x) = p, for even m."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total
    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest element first, so that no square overflows."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def directions(d: int, near: Nearest) -> np.ndarray:
    return np.random.default_rng((near.seed, d)).standard_normal((d, near.axes))


class Tree:
    """The top of the kd-tree over projections, a full binary tree of ``depth`` levels."""

    def __init__(self, p: np.ndarray, depth: int):
        self.depth, n = depth, (1 << depth) - 1
        self.axis, self.at = np.zeros(n, np.int32), np.zeros(n)
        m = p.shape[1]
        self.lo, self.hi = np.full((2 * n + 1, m), -np.inf), np.full((2 * n + 1, m), np.inf)
        held = {0: p}
        for node in range(n):
            part = held.pop(node)
            axis = int(np.argmax(part.var(axis=0))) if len(part) else 0
            at = float(np.median(part[:, axis])) if len(part) else 0.0
            self.axis[node], self.at[node] = axis, at
            right = part[:, axis] > at
            for child, rows in ((2 * node + 1, part[~right]), (2 * node + 2, part[right])):
                held[child] = rows
                self.lo[child], self.hi[child] = self.lo[node], self.hi[node]
            self.hi[2 * node + 1, axis] = self.lo[2 * node + 2, axis] = at
        self.lo, self.hi = self.lo[n:], self.hi[n:]

    def cells(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (p[np.arange(len(p)), self.axis[node]] > self.at[node])
        return node - ((1 << self.depth) - 1)


def _binary(m: np.ndarray) -> list[bytes]:
    m = np.ascontiguousarray(m)
    width, raw = m.shape[1] * m.itemsize, m.tobytes()
    return [raw[at:at + width] for at in range(0, len(raw), width)]


def _floats(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def fit_trees(rows: DataFrame, near: Nearest) -> dict[int, Tree]:
    """Trees by vector length, fitted on projections of a bounded sample of the vectors."""
    counts = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(near.lengths).collect()
    total = sum(r["count"] for r in counts)
    lengths = [r["d"] for r in counts]
    some = rows.where(F.size("v").isin(lengths)) if lengths else rows.limit(0)
    if total > near.sample:   # by the vector's own hash: copies come together or not at all
        some = some.where(F.pmod(F.xxhash64("v"), F.lit(total)) < near.sample)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, v, _ in by_length(batch):
                p = unit_rows(v) @ directions(d, near)
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(p), pa.int32()), pa.array(_binary(p))], names=["d", "p"])

    found = some.select("v").dropDuplicates(["v"]).mapInArrow(project, "d int, p binary").toArrow()
    trees, of = {}, np.array(found["d"].to_pylist(), np.int64)
    p = np.frombuffer(b"".join(found["p"].to_pylist())).reshape(-1, near.axes)
    for r in counts:
        part = p[of == r["d"]]
        part = part[np.lexsort(part.T)]   # the same tree whatever order the rows came in
        wanted = min(r["count"] / near.cell, len(part) / 16)
        trees[r["d"]] = Tree(part, max(0, math.ceil(math.log2(wanted))) if wanted > 1 else 0)
    return trees


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, vectors, their rows) of the column ``v``, one group a length."""
    v = batch.column("v")
    sizes, values = v.value_lengths().to_numpy(), v.flatten().to_numpy()
    ends = np.cumsum(sizes)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), values[(ends[rows] - d)[:, None] + np.arange(d)], rows


def place(rows: DataFrame, trees: dict[int, Tree], near: Nearest, width: int) -> DataFrame:
    """(d, cell, ids, u, p) of rows (ids, v): ids are ``width`` longs, u the unit vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            for d, v, at in by_length(batch):
                u = unit_rows(v)
                p = u @ directions(d, near)
                cell = trees[d].cells(p) if d in trees else np.zeros(len(p), np.int64)
                m = np.full((len(at), width), NO_ID)
                for row, i in enumerate(at):
                    m[row, :len(ids[i])] = ids[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(at), pa.int32()), pa.array(cell), pa.array(_binary(m)), pa.array(_binary(u)), pa.array(_binary(p))],
                    names=["d", "cell", "ids", "u", "p"])

    return rows.select("ids", "v").mapInArrow(run, "d int, cell long, ids binary, u binary, p binary")


def kd_order(p: np.ndarray, leaf: int) -> np.ndarray:
    """Rows in the order of the leaves of a kd-tree: parts are halved along their
    widest axis at a multiple of ``leaf``, so leaf i is rows i * leaf to (i + 1) * leaf."""
    order, todo = np.arange(len(p)), [(0, len(p))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo > leaf:
            part = p[order[lo:hi]]
            mid = -(-(hi - lo) // leaf) // 2 * leaf
            order[lo:hi] = order[lo:hi][np.argpartition(part[:, np.argmax(np.ptp(part, axis=0))], mid)]
            todo += [(lo, lo + mid), (lo + mid, hi)]
    return order


def packed(rows: DataFrame, size: int, near: Nearest, name: str) -> DataFrame:
    """Placed rows of one cell as written rows of at most ``size`` of them in kd order."""
    ordered = rows.withColumn("h", F.xxhash64("u")).repartitionByRange("d", "cell", "h").sortWithinPartitions("d", "cell", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(t: pa.Table) -> pa.RecordBatch:
            columns = [t[c].to_pylist() for c in ("ids", "u", "p")]
            order = kd_order(np.frombuffer(b"".join(columns[2])).reshape(-1, near.axes), near.leaf)
            return pa.RecordBatch.from_arrays(
                [pa.array([t["d"][0].as_py()], pa.int32()), pa.array([t["cell"][0].as_py()], pa.int64())]
                + [pa.array([b"".join(c[i] for i in order)]) for c in columns], names=["d", "cell", "ids", "u", "p"])

        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = np.stack([held[c].to_numpy() for c in ("d", "cell")], axis=1)
            ends, lo = [*(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)], 0
            for hi in ends:
                while hi - lo >= size or (hi < len(key) and hi > lo):
                    yield pack(held.slice(lo, min(size, hi - lo)))
                    lo += min(size, hi - lo)
            held = held.slice(lo).combine_chunks()
        if held is not None and len(held):
            yield pack(held)

    made = ordered.select("d", "cell", "ids", "u", "p").mapInArrow(run, "d int, cell long, ids binary, u binary, p binary")
    return cut(made.withColumn("id", F.monotonically_increasing_id()), name)


def box_distance(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of every query to every box."""
    out = np.zeros((len(q), len(lo)))
    for a in range(q.shape[1]):
        x = q[:, a, None]
        gap = np.maximum(np.maximum(lo[None, :, a] - x, x - hi[None, :, a]), 0)
        out += gap * gap
    return out


def search_tile(u: np.ndarray, p: np.ndarray, ids: np.ndarray, qu: np.ndarray, qp: np.ndarray,
                bound: np.ndarray, near: Nearest) -> tuple[np.ndarray, np.ndarray]:
    """Scores and points of the k + 1 best points of a tile for every query, best first;
    ``bound`` is the squared distance that points must not exceed (-inf score: none)."""
    keep, n, leaf = near.k + 1, len(u), near.leaf
    x = chi_square_quantile(near.confidence, near.axes)
    starts = np.arange(0, n, leaf)
    boxes = box_distance(qp, np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts))
    turn = np.argsort(boxes, axis=1, kind="stable")
    best = np.full((len(qu), keep), -np.inf)
    point = np.full((len(qu), keep), -1)
    first = np.append(ids[:, 0], NO_ID)            # ties go to the smaller id; -1 is no point
    reach = bound.copy()
    at = np.arange(len(qu))
    for step in range(len(starts)):
        leaves = turn[at, step]
        go = boxes[at, leaves] <= reach[at] * x + 1e-12   # the stopping test
        at, leaves = at[go], leaves[go]
        if not len(at):
            break
        j = leaves[:, None] * leaf + np.arange(leaf)
        there = j < n
        j = np.minimum(j, n - 1)
        gap = p[j] - qp[at, None, :]
        there &= np.einsum("qla,qla->ql", gap, gap) <= (reach[at] * x + 1e-12)[:, None]
        a, b = np.nonzero(there)
        scores = np.full(j.shape, -np.inf)
        scores[a, b] = np.einsum("ij,ij->i", qu[at[a]], u[j[a, b]])
        scores = np.concatenate((best[at], scores), axis=1)
        points = np.concatenate((point[at], np.where(there, j, -1)), axis=1)
        order = np.lexsort((first[points], -scores), axis=1)[:, :keep]
        best[at], point[at] = np.take_along_axis(scores, order, 1), np.take_along_axis(points, order, 1)
        reach[at] = np.minimum(bound[at], np.maximum(0, 2 - 2 * np.maximum(best[at, -1], -1e300)))
    return best, point


class Best:
    """The k + 1 best points so far of the queries of one chunk, best first; ties go to the smaller id."""

    def __init__(self, near: Nearest) -> None:
        self.key = np.zeros(near.chunk, np.int64)
        self.score = np.full((near.chunk, near.k + 1), -np.inf)
        self.ids = np.full((near.chunk, near.k + 1, near.k + 1), NO_ID)

    def add(self, q: np.ndarray, keys: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate((self.score[q], score), axis=1), np.concatenate((self.ids[q], ids), axis=1)
        order = np.lexsort((ids[:, :, 0], -score), axis=1)[:, :self.score.shape[1]]
        self.key[q], self.score[q] = keys, np.take_along_axis(score, order, 1)
        self.ids[q] = np.take_along_axis(ids, order[:, :, None], 1)

    def batch(self, chunk: int) -> pa.RecordBatch:
        q, j = np.nonzero(self.score > -np.inf)
        ids = self.ids[q, j]
        there = ids != NO_ID
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(there.sum(axis=1)))).astype(np.int32), pa.array(ids[there]))
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(q), pa.int64()), pa.array(q), pa.array(self.key[q]), pa.array(self.score[q, j]), lists],
            names=["chunk", "q", "key", "score", "ids"])


#: Chunks whose best points a task holds at a time, about 90 KB each.
HELD = 512


def search(pairs: DataFrame, near: Nearest) -> DataFrame:
    """(chunk, q, key, score, ids) of pairs of a tile (ids, u, p) and a chunk of queries
    (chunk, q, keys, qu, qp, bound): at most k + 1 points a query and task, whatever the
    number of its tiles (a task lets go of the chunks it holds when they are many)."""
    width = near.k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                p, qp = (np.frombuffer(r[c]).reshape(-1, near.axes) for c in ("p", "qp"))
                u, qu = (np.frombuffer(r[c]).reshape(-1, r["d"]) for c in ("u", "qu"))
                ids = np.frombuffer(r["ids"], np.int64).reshape(-1, width)
                q, keys, bound = np.frombuffer(r["q"], np.int64), np.frombuffer(r["keys"], np.int64), np.frombuffer(r["bound"])
                score, point = search_tile(u, p, ids, qu, qp, bound, near)
                # k + 1 points are known that are better than one beyond the bound
                score = np.where((point >= 0) & (2 - 2 * score <= bound[:, None] + 1e-12), score, -np.inf)
                found = np.where((score > -np.inf)[:, :, None], ids[point], NO_ID)
                if r["chunk"] not in held and len(held) >= HELD:
                    for chunk, best in held.items():
                        yield best.batch(chunk)
                    held.clear()
                held.setdefault(r["chunk"], Best(near)).add(q, keys, score, found)
        for chunk, best in held.items():
            yield best.batch(chunk)

    return pairs.select("d", "ids", "u", "p", "chunk", "q", "keys", "qu", "qp", "bound").mapInArrow(
        run, "chunk long, q long, key long, score double, ids array<long>")


def route(chunks: DataFrame, trees: dict[int, Tree], near: Nearest) -> DataFrame:
    """Chunks with bounds, once for each cell but their own that the radius of one of
    their queries reaches, with those queries only."""
    x = chi_square_quantile(near.confidence, near.axes)
    names = ["d", "cell", "chunk", "q", "keys", "qu", "qp", "bound"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                tree = trees.get(r["d"])
                if tree is None or not tree.depth:
                    continue
                m = {c: np.frombuffer(r[c], t).reshape(-1, w) for c, t, w in (
                    ("q", np.int64, 1), ("keys", np.int64, 1), ("qu", float, r["d"]), ("qp", float, near.axes), ("bound", float, 1))}
                hit = box_distance(m["qp"], tree.lo, tree.hi) <= m["bound"] * x + 1e-12
                hit[:, r["cell"]] = False
                for cell in np.flatnonzero(hit.any(axis=0)).tolist():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["d"]], pa.int32()), pa.array([cell]), pa.array([r["chunk"]])]
                        + [pa.array([v[hit[:, cell]].tobytes()]) for v in m.values()], names=names)

    return chunks.select(*names).mapInArrow(
        run, "d int, cell long, chunk long, q binary, keys binary, qu binary, qp binary, bound binary")


def with_bounds(chunks: DataFrame, found: DataFrame, near: Nearest) -> DataFrame:
    """Chunks with the squared distance of each query's (k + 1)-th best point so far."""
    last = F.row_number().over(Window.partitionBy("chunk", "q").orderBy(F.desc("score")))
    bound = (found.withColumn("r", last).where(F.col("r") == near.k + 1)
             .groupBy("chunk").agg(F.collect_list(F.struct("q", "score")).alias("scores")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for q, scores in zip(batch.column("q").to_pylist(), batch.column("scores").to_pylist()):
                b = np.full(len(q) // 8, np.inf)
                for s in scores or []:
                    b[s["q"]] = max(0.0, 2 - 2 * s["score"])
                bounds.append(b.tobytes())
            at = batch.schema.get_field_index("bound")
            yield batch.set_column(at, "bound", pa.array(bounds, pa.binary())).drop_columns(["scores"])

    return chunks.join(bound, "chunk", "left").select(*chunks.columns, "scores").mapInArrow(run, chunks.schema)


def nearest(embeddings: DataFrame, near: Nearest = Nearest()) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of every query found."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & linkable(F.col("v")))
    trees = fit_trees(rows, near)

    # equal vectors are one point, with the ids that an answer can hold
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    points = rows.withColumn("r", first).where(F.col("r") <= near.k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    tiles = packed(cut(place(points, trees, near, near.k + 1), "points"), near.tile, near, "tiles")

    asked = cut(rows.where(F.col("vec_id") % near.every == 0).distinct(), "asked")
    vectors = cut(asked.select("v").distinct().withColumn("key", F.monotonically_increasing_id()), "queries")
    placed = cut(place(vectors.select(F.array("key").alias("ids"), "v"), trees, near, 1), "placed")
    count = (F.octet_length("ids") / 8).cast("int")
    numbers = F.udf(lambda n: np.arange(n, dtype=np.int64).tobytes(), "binary")
    open_bound = F.udf(lambda n: np.full(n, np.inf).tobytes(), "binary")
    chunks = cut(packed(placed, near.chunk, near, "chunks").select(
        "d", "cell", F.col("id").alias("chunk"), numbers(count).alias("q"), F.col("ids").alias("keys"),
        F.col("u").alias("qu"), F.col("p").alias("qp"), open_bound(count).alias("bound")), "chunks")

    points_of = tiles.drop("id")
    # by cell, so that the tiles of a cell meet a chunk in one task and give one answer
    home = cut(search(chunks.join(points_of.hint("merge"), ["d", "cell"]), near), "home")
    routed = cut(route(with_bounds(chunks, home, near), trees, near), "routed")
    away = search(routed.join(points_of.hint("merge"), ["d", "cell"]), near)

    answers = home.unionByName(away).select("key", "score", F.explode("ids").alias("id"))
    order = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
    answers = (answers.withColumn("r", order).where(F.col("r") <= near.k + 1)
               .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("r", "score", "id"))).alias("found")))
    # a query leaves its own row out of its vector's answers, if it is among them
    own = F.array_position(F.transform("found", lambda x: x["id"]), F.col("vec_id"))
    rest = F.filter("found", lambda x: (own == 0) | (x["r"] != own))
    asked = asked.join(vectors, "v").select("vec_id", "key")
    return asked.join(answers, "key").select(
        F.col("vec_id").alias("query_id"), F.posexplode(F.slice(rest, 1, near.k)).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
