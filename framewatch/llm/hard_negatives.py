"""Hard negatives from Hilbert-ordered blocks with zone maps.

Components become integers floor(256 x); the score of two rows is their integer inner product.
Rows are put on a Hilbert curve over their leading principal axes and written as blocks of
neighbours, each with a zone map: the smallest and largest value of every dimension, and of
the label.  For an anchor a, interval arithmetic on a zone map bounds every score in its block:

    sum_i min(a_i lo_i, a_i hi_i)  <=  score  <=  sum_i max(a_i lo_i, a_i hi_i)

Positives: the fifth best row of its label in an anchor's own block is a floor; only blocks
that hold the label and whose upper bound reaches the floor are read.  Negatives: a positive of score
p opens the window p/2 <= score <= 0.95 p.  The third best row of another label inside the
window in the own block raises the window's lower end; only blocks whose bounds meet
what remains of a window are read.  Bounds are never below a score, so results are exact.

Anchors travel in chunks, one for the anchors of a block.  Zone maps are read in pages
of ``page`` neighbouring blocks; a page whose own box fails is skipped whole.  The
stated set of anchors meets the zone maps in these units, never row by row, and a block is
read with all anchors of a chunk that need it.  Blocks are a written table, so
lost tasks read them again.

Bounds: the axes of the curve are fitted on ``sample`` rows on average, for the
``lengths`` most frequent vector lengths; they set an order of work only.

Defined cases: rows with a null vec_id or label, or a vector that is null, empty or holds null
or non-finite elements, take no part.  Rows meet rows of their own vector length only.
Integers beyond 2**62 count as that; scores are 64-bit and keep to that range.  Rows that
repeat an id are rows of their own; a repeated anchor (equal id, label and vector) is answered
once, with its other row among its positives.  A positive score below zero opens no window.
An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .nearest import by_length

FLOOR = -(1 << 62)     # below every score
PAIRS = "block long, chunk long, d int, a_ids binary, a_labels binary, a_q binary, a_row binary, a_own binary, a_low binary, a_high binary, a_at binary"


@dataclass(frozen=True)
class HardNegatives:
    positives: int = 5
    negatives: int = 3
    every: int = 50          # anchors are the rows whose vec_id it divides
    low_percent: int = 50    # of the positive score, at least
    high_percent: int = 95   # and at most
    scale: int = 256
    block: int = 1024        # rows in a block
    page: int = 512          # blocks in a page of zone maps
    axes: int = 8            # of the curve
    bits: int = 8            # an axis
    sample: int = 4096       # rows that the axes are fitted on
    lengths: int = 64        # vector lengths that get axes


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (rows, axes) on the Hilbert curve of 2**bits cells an axis,
    by the transposed form (Skilling 2004): undo the excess work, then Gray encode."""
    x = x.astype(np.uint64).copy()
    n, one = x.shape[1], np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(n):
            up = (x[:, i] & q) != 0
            t = np.where(up, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(up, low, t)
            x[:, i] ^= t
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.uint64)
    for b in range(bits - 1, 0, -1):
        t ^= np.where(x[:, n - 1] >> np.uint64(b) & one, (one << np.uint64(b)) - one, np.uint64(0))
    x ^= t[:, None]
    key = np.zeros(len(x), np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << one | (x[:, i] >> np.uint64(b) & one)
    return key


class Curve:
    """Leading principal axes of a sample, and the range of the sample along them."""

    def __init__(self, m: np.ndarray, mine: HardNegatives):
        self.middle, self.bits = m.mean(axis=0), mine.bits
        centred = m - self.middle
        self.axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :mine.axes]
        at = centred @ self.axes
        self.lo, self.span = at.min(axis=0), np.maximum(np.ptp(at, axis=0), 1e-300)

    def keys(self, m: np.ndarray) -> np.ndarray:
        at = ((m - self.middle) @ self.axes - self.lo) / self.span
        return hilbert(np.clip(at * (1 << self.bits), 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def integers(embeddings: DataFrame, mine: HardNegatives) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v holding whole numbers."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & (F.size(v) > 0)
    edge = F.lit(float(1 << 62))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    label, i = F.col("label").cast("long"), F.col("vec_id").cast("long")
    whole = F.transform(v, lambda x: F.greatest(-edge, F.least(edge, F.floor(x * mine.scale).cast("double"))).cast("long"))
    return rows.select(i.alias("vec_id"), F.when(i % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), whole.alias("v"))


def fit_curves(rows: DataFrame, mine: HardNegatives) -> dict[int, Curve]:
    counts = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(mine.lengths).collect()
    total = sum(r["count"] for r in counts)
    if not total:
        return {}
    some = rows.where(F.size("v").isin([r["d"] for r in counts]))
    if total > mine.sample:   # by the vector's own hash, whatever the order of the rows
        some = some.where(F.pmod(F.xxhash64("v"), F.lit(total)) < mine.sample)
    found = some.select("v").dropDuplicates(["v"]).toArrow().combine_chunks()
    curves = {}
    for batch in found.to_batches():
        for d, m, _ in by_length(batch):
            m = m[np.lexsort(m.T)].astype(np.float64)
            if np.abs(m).max() < 1e150 and len(m) > 1:
                curves[d] = Curve(m, mine)
    return curves


def _narrow(m: np.ndarray) -> bytes:
    return (m.astype(np.int32) if np.abs(m).max(initial=0) < 1 << 31 else m).tobytes()


def _wide(raw: bytes, n: int, d: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32 if len(raw) == 4 * n * d else np.int64).reshape(n, d)


def write_blocks(rows: DataFrame, mine: HardNegatives) -> DataFrame:
    """(block, d, n, ids, labels, q, lo, hi, label_lo, label_hi), in the order of the curve."""
    curves = fit_curves(rows, mine)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, m, at in by_length(batch):
                key = curves[d].keys(m.astype(np.float64)) if d in curves else np.zeros(len(m), np.uint64)
                raw = [x.tobytes() for x in np.ascontiguousarray(m)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(at)), batch.column("label").take(pa.array(at)), pa.array([d] * len(at), pa.int32()),
                     pa.array((key ^ np.uint64(1 << 63)).view(np.int64)), pa.array(raw)], names=["vec_id", "label", "d", "key", "q"])

    placed = cut(rows.select("vec_id", "label", "v").mapInArrow(place, "vec_id long, label long, d int, key long, q binary"), "placed")
    order = ["d", "key", F.xxhash64("q", "vec_id")]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(t: pa.Table) -> pa.RecordBatch:
            n, d = len(t), t["d"][0].as_py()
            q = np.frombuffer(b"".join(t["q"].to_pylist()), np.int64).reshape(n, d)
            labels = t["label"].to_numpy()
            return pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([n], pa.int32()), pa.array([t["vec_id"].to_numpy().tobytes()]), pa.array([labels.tobytes()]),
                 pa.array([_narrow(q)]), pa.array([q.min(axis=0).astype(np.float64).tobytes()]), pa.array([q.max(axis=0).astype(np.float64).tobytes()]),
                 pa.array([labels.min()]), pa.array([labels.max()])], names=["d", "n", "ids", "labels", "q", "lo", "hi", "label_lo", "label_hi"])

        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            d = held["d"].to_numpy()
            ends, lo = [*(np.flatnonzero(d[1:] != d[:-1]) + 1).tolist(), len(d)], 0
            for hi in ends:
                while hi - lo >= mine.block or (hi < len(d) and hi > lo):
                    yield block(held.slice(lo, min(mine.block, hi - lo)))
                    lo += min(mine.block, hi - lo)
            held = held.slice(lo).combine_chunks()
        if held is not None and len(held):
            yield block(held)

    made = ordered.select("vec_id", "label", "d", "q").mapInArrow(
        pack, "d int, n int, ids binary, labels binary, q binary, lo binary, hi binary, label_lo long, label_hi long")
    return cut(made.withColumn("block", F.monotonically_increasing_id()), "blocks")


def zone_pages(blocks: DataFrame, mine: HardNegatives) -> DataFrame:
    """Zone maps of neighbouring blocks as one row; only their columns are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column("d").to_numpy()
            ends, lo = [*(np.flatnonzero(d[1:] != d[:-1]) + 1).tolist(), len(d)], 0
            for hi in ends:
                for at in range(lo, hi, mine.page):
                    part = batch.slice(at, min(mine.page, hi - at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(d[at])], pa.int32())]
                        + [pa.array([part.column(c).to_numpy().tobytes()]) for c in ("block", "label_lo", "label_hi")]
                        + [pa.array([b"".join(part.column(c).to_pylist())]) for c in ("lo", "hi")],
                        names=["d", "z_block", "z_label_lo", "z_label_hi", "z_lo", "z_hi"])
                lo = hi

    made = blocks.select("d", "block", "label_lo", "label_hi", "lo", "hi").mapInArrow(
        run, "d int, z_block binary, z_label_lo binary, z_label_hi binary, z_lo binary, z_hi binary")
    return cut(made.withColumn("page", F.monotonically_increasing_id()), "zones")


def score_bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of anchors (rows of a) in boxes (rows of lo, hi).
    The slack covers rounding; it is nothing while sums stay below 2**53."""
    a = a.astype(np.float64)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    most = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T
    slack = np.where(most < 2.0 ** 52, 0.0, most * 1e-12)
    return up @ lo.T + down @ hi.T - slack, up @ hi.T + down @ lo.T + slack


def inner(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where these are exact, else modulo 2**64, which
    is right wherever the true sum fits; other sums keep to the limits."""
    x, y = a.astype(np.float64), q.astype(np.float64)
    if float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * a.shape[1] < 2.0 ** 53:
        return (x @ y.T).astype(np.int64)
    about = x @ y.T
    exact = a.astype(np.int64) @ q.astype(np.int64).T
    return np.where(np.abs(about) >= 2.0 ** 62, np.where(about > 0, -FLOOR, FLOOR), exact)


def _anchors(r: dict) -> dict:
    """The arrays of a chunk of anchors."""
    ids = np.frombuffer(r["a_ids"], np.int64)
    windows = np.frombuffer(r["a_low"], np.int64).reshape(len(ids), -1)
    return {"ids": ids, "labels": np.frombuffer(r["a_labels"], np.int64), "q": _wide(r["a_q"], len(ids), r["d"]),
            "row": np.frombuffer(r["a_row"], np.int64), "own": np.frombuffer(r["a_own"], np.int64), "low": windows,
            "high": np.frombuffer(r["a_high"], np.int64).reshape(windows.shape), "at": np.frombuffer(r["a_at"], np.int64)}


def _chunk(block: int, chunk: int, d: int, a: dict, some: np.ndarray) -> pa.RecordBatch:
    names = [x.split()[0] for x in PAIRS.split(", ")]
    parts = [a[c][some] for c in ("ids", "labels", "q", "row", "own", "low", "high", "at")]
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([chunk]), pa.array([d], pa.int32())]
                                      + [pa.array([_narrow(x) if k == 2 else np.ascontiguousarray(x).tobytes()]) for k, x in enumerate(parts)], names=names)


def own_anchors(blocks: DataFrame, mine: HardNegatives) -> DataFrame:
    """The anchors of every block as one chunk, with the floor that their own block gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                ids, labels, q = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), _wide(r["q"], r["n"], r["d"])
                row = np.flatnonzero(ids % mine.every == 0)
                if not len(row):
                    continue
                scores = inner(q[row], q)
                scores[(labels[row][:, None] != labels[None, :]) | (row[:, None] == np.arange(len(ids)))] = FLOOR
                best = np.sort(scores, axis=1)[:, ::-1]
                low = best[:, mine.positives - 1:mine.positives] if best.shape[1] >= mine.positives else np.full((len(row), 1), FLOOR)
                a = {"ids": ids[row], "labels": labels[row], "q": q[row], "row": row, "own": np.full(len(row), r["block"]),
                     "low": low, "high": np.full_like(low, -FLOOR), "at": np.arange(len(row))}
                yield _chunk(r["block"], r["block"], r["d"], a, np.arange(len(row)))

    return cut(blocks.select("block", "d", "n", "ids", "labels", "q").mapInArrow(run, PAIRS), "anchors")


def choose(chunks: DataFrame, pages: DataFrame, same: bool) -> DataFrame:
    """The blocks that chunks must read, with the anchors that need them: blocks with a row of the same
    (or of another) label whose bounds meet what is left of a window [low, high]."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                a = _anchors(r)
                ids, first, last = (np.frombuffer(r[c], np.int64) for c in ("z_block", "z_label_lo", "z_label_hi"))
                lo, hi = (np.frombuffer(r[c]).reshape(-1, r["d"]) for c in ("z_lo", "z_hi"))
                floor, top = a["low"].min(axis=1), a["high"].max(axis=1)
                under, over = score_bounds(a["q"], lo.min(axis=0)[None], hi.max(axis=0)[None])
                some = np.flatnonzero((over[:, 0] >= floor) & (under[:, 0] <= top))
                if not len(some):
                    continue
                under, over = score_bounds(a["q"][some], lo, hi)
                label = a["labels"][some][:, None]
                hit = (first <= label) & (label <= last) if same else ~((first == label) & (label == last))
                meets = np.zeros_like(hit)
                for w in range(a["low"].shape[1]):
                    low, high = a["low"][some, w, None], a["high"][some, w, None]
                    meets |= (low <= high) & (over >= low) & (under <= high)
                hit &= meets
                for j in np.flatnonzero(hit.any(axis=0)):
                    yield _chunk(int(ids[j]), r["chunk"], r["d"], a, some[hit[:, j]])

    # every page meets every chunk of its vector length: the stated set of anchors, in blocks
    met = chunks.drop("block").join(pages.select("d", "page"), "d").join(pages.drop("d"), "page").drop("page")
    return met.mapInArrow(run, PAIRS)


def read_blocks(pairs: DataFrame, blocks: DataFrame, same: bool, keep: int) -> DataFrame:
    """(chunk, at, w, score, vec_id): for every anchor and window the best ``keep`` rows of a block in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                a = _anchors(r)
                ids, labels, q = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), _wide(r["q"], r["n"], r["d"])
                scores = inner(a["q"], q)
                fits = (labels[None, :] == a["labels"][:, None]) == same
                fits[(a["own"] == r["block"]).nonzero()[0], a["row"][a["own"] == r["block"]]] = False   # its own row
                fits &= (scores >= a["low"].min(axis=1)[:, None]) & (scores <= a["high"].max(axis=1)[:, None])
                out = []
                for i in np.flatnonzero(fits.any(axis=1)):
                    rows = np.flatnonzero(fits[i])
                    rows = rows[np.lexsort((ids[rows], -scores[i, rows]))]
                    s = scores[i, rows]
                    for w, (low, high) in enumerate(zip(a["low"][i], a["high"][i])):
                        start = np.searchsorted(-s, -high)
                        for x in rows[start:start + keep][s[start:start + keep] >= low]:
                            out.append((r["chunk"], int(a["at"][i]), w, int(scores[i, x]), int(ids[x])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["chunk", "at", "w", "score", "vec_id"])

    there = blocks.select("block", "n", "ids", "labels", "q")
    return pairs.join(there, "block").mapInArrow(run, "chunk long, at long, w int, score long, vec_id long")


def windows(chunks: DataFrame, found: DataFrame, width: int, mine: HardNegatives) -> DataFrame:
    """Chunks whose windows come from ``found`` (chunk, at, w, low, high); windows without a row are shut."""
    given = found.groupBy("chunk").agg(F.collect_list(F.struct("at", "w", "low", "high")).alias("given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                a = _anchors(r)
                a["low"], a["high"] = np.full((len(a["ids"]), width), -FLOOR), np.full((len(a["ids"]), width), FLOOR)
                for g in r["given"]:
                    a["low"][g["at"], g["w"]], a["high"][g["at"], g["w"]] = g["low"], g["high"]
                yield _chunk(r["block"], r["chunk"], r["d"], a, np.arange(len(a["ids"])))

    return chunks.join(given, "chunk").select(*[x.split()[0] for x in PAIRS.split(", ")], "given").mapInArrow(run, PAIRS)


def anchor_names(chunks: DataFrame) -> DataFrame:
    """(chunk, at, anchor_id), one for rows of equal id, label and vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                a = _anchors(r)
                n = len(a["ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["chunk"]] * n, pa.int64()), pa.array(a["at"]), pa.array(a["ids"]), pa.array(a["labels"]),
                     pa.array([x.astype(np.int64).tobytes() for x in a["q"]])], names=["chunk", "at", "anchor_id", "label", "q"])

    rows = chunks.mapInArrow(run, "chunk long, at long, anchor_id long, label long, q binary")
    one = rows.groupBy("anchor_id", "label", "q").agg(F.min(F.struct("chunk", "at")).alias("first"))
    return one.select("first.chunk", "first.at", "anchor_id")


def hard_negatives(embeddings: DataFrame, mine: HardNegatives = HardNegatives()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank."""
    blocks = write_blocks(integers(embeddings, mine), mine)
    pages = zone_pages(blocks, mine)
    anchors = own_anchors(blocks, mine)

    found = read_blocks(choose(anchors, pages, True), blocks, True, mine.positives)
    order = F.row_number().over(Window.partitionBy("chunk", "at").orderBy(F.desc("score"), "vec_id"))
    positives = cut(found.withColumn("r", order).where(F.col("r") <= mine.positives).select(
        "chunk", "at", (F.col("r") - 1).alias("w"), "score", "vec_id"), "positives")

    # whole numbers n with low% of p <= n <= high% of p, for p >= 0, in whole numbers throughout
    share = lambda percent: F.expr(f"score div 100 * {percent} + score % 100 * {percent} div 100")
    opened = positives.where("score >= 0").select(
        "chunk", "at", "w", (F.col("score") - share(100 - mine.low_percent)).alias("low"), share(mine.high_percent).alias("high")).where("low <= high")

    asked = cut(windows(anchors, opened, mine.positives, mine), "windows")

    # what the own block holds raises the lower ends; then the blocks that can still add something
    here = read_blocks(asked, blocks, False, mine.negatives)
    best = F.row_number().over(Window.partitionBy("chunk", "at", "w").orderBy(F.desc("score"), "vec_id"))
    raised = here.withColumn("r", best).where(F.col("r") == mine.negatives).select("chunk", "at", "w", F.col("score").alias("least"))
    narrowed = opened.join(raised, ["chunk", "at", "w"], "left").withColumn("low", F.coalesce("least", "low")).drop("least")
    narrowed = cut(windows(anchors, narrowed, mine.positives, mine), "narrowed")
    negatives = read_blocks(choose(narrowed, pages, False), blocks, False, mine.negatives)
    negatives = negatives.withColumn("rank", best).where(F.col("rank") <= mine.negatives)

    out = negatives.join(positives.select("chunk", "at", "w", F.col("score").alias("p_score"), F.col("vec_id").alias("p_id")), ["chunk", "at", "w"])
    return out.join(anchor_names(anchors), ["chunk", "at"]).select(
        "anchor_id", F.col("p_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"), (F.col("w") + 1).cast("int").alias("positive_rank"))


#: The same rows in SQL: every anchor against every row.
SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT a, b, s, CAST(row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS INTEGER) AS r FROM s WHERE same QUALIFY r <= 5),
n AS (
  SELECT p.a, p.b, p.s, p.r, s.b AS n, s.s AS t, CAST(row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.s DESC, s.b) AS INTEGER) AS k
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s QUALIFY k <= 3)
SELECT a AS anchor_id, b AS positive_id, k AS rank, n AS negative_id, s AS positive_score, t AS negative_score, r AS positive_rank FROM n"""
