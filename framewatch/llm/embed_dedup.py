"""Exact near-duplicate search over embeddings by PCA-ordered tiles.

Vectors are compared within their label.  Equal vectors are one class.  The
unit vectors are turned into the axes of their principal components, so the
leading coordinates carry most of a product.  Each label is cut into tiles of
neighbours along the first axis, and only tiles that can hold a pair near enough
along it are compared.  For two tiles the products of leading coordinates are
summed first; what the other coordinates can still add is at most the product of
the two suffix norms, so pairs that cannot reach the threshold are dropped block
of coordinates by block.  Survivors are decided by the cosine of the original
vectors in double precision.

A pair of tiles returns at most one row per vector: how many vectors it links
with, and the smallest linked one it can reach inside the two tiles.  Large groups
of near copies therefore never become rows of pairs.

The principal axes are only an order of work: they are fitted on the summed
products of all vectors (one matrix of fixed size for each partition) and do not
influence which pairs are found.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
elements, a null label and a null vec_id link with nothing; such rows come back
with n_links 0 and their own id.  Vectors of different lengths never link.  Rows
that repeat a vec_id count as vectors of their own.  An empty table gives an empty
table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import components, reach

SLACK = 1e-9


@dataclass(frozen=True)
class NearVectors:
    threshold: float = 0.98
    tile: int = 1024          # vectors in a tile
    block: int = 16           # coordinates summed between two tests
    lengths: int = 64         # vector lengths, the most frequent ones, that get axes of their own


def linkable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame, near: NearVectors) -> dict[int, np.ndarray]:
    """For every vector length the axes of the summed products of its unit vectors,
    largest first.  At most ``lengths`` matrices are kept; others need no axes."""
    lengths = [r[0] for r in classes.groupBy(F.size("v")).count().orderBy(F.desc("count"), F.asc("size(v)")).limit(near.lengths).collect()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for d in batches:
            for n, part in d.groupby(d["v"].map(len)):
                if n in lengths:
                    u = _unit(np.stack(part["v"].to_numpy()))
                    sums[n] = sums.get(n, 0) + u.T @ u
        for n, s in sums.items():
            yield pd.DataFrame({"n": n, "row": np.arange(n), "values": list(s)})

    rows = classes.select("v").mapInPandas(run, "n int, row int, values array<double>")
    sums = (rows.select("n", "row", F.posexplode("values").alias("col", "x"))
            .groupBy("n", "row", "col").agg(F.sum("x").alias("x")).toPandas())
    axes = {}
    for n, part in sums.groupby("n"):
        m = np.zeros((n, n))
        m[part["row"], part["col"]] = part["x"]
        axes[int(n)] = np.linalg.eigh(m)[1][:, ::-1].copy()
    return axes


def compare_tiles(a: np.ndarray, b: np.ndarray, same: bool, axes: np.ndarray | None, near: NearVectors) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of all linked pairs of two tiles of vectors (i < j within one)."""
    ua = _unit(a)
    ub = ua if same else _unit(b)
    ra, rb = (ua, ub) if axes is None else (ua @ axes, ub @ axes)
    sa, sb = (np.sqrt(np.maximum(0, np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1])) for r in (ra, rb))
    sa, sb = (np.hstack((s, np.zeros((len(s), 1)))) for s in (sa, sb))
    d, left, right = a.shape[1], [], []
    for at in range(0, len(a), 256):
        k = min(near.block, d)
        rows = slice(at, min(at + 256, len(a)))
        part = ra[rows, :k] @ rb[:, :k].T
        i, j = np.nonzero(part + np.outer(sa[rows, k], sb[:, k]) >= near.threshold - SLACK)
        dot = part[i, j]
        i += at
        if same:
            i, j, dot = (x[i < j] for x in (i, j, dot))
        while k < d and len(i):
            e = min(k + near.block, d)
            dot = dot + np.einsum("ij,ij->i", ra[i, k:e], rb[j, k:e])
            k = e
            keep = dot + sa[i, k] * sb[j, k] >= near.threshold - SLACK
            i, j, dot = i[keep], j[keep], dot[keep]
        if len(i):  # the stated measure, on the vectors as they came
            keep = np.einsum("ij,ij->i", ua[i], ub[j]) >= near.threshold
            left.append(i[keep])
            right.append(j[keep])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def near_vectors(embeddings: DataFrame, near: NearVectors = NearVectors()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                             F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("links", linkable(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # an array's hash only deals rows out; equality is that of the arrays
    classes = cut(rows.where("links").groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
                  .withColumn("key", F.monotonically_increasing_id()), "vectors")
    axes = principal_axes(classes, near)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            at = np.zeros(len(d))
            for n, part in d.groupby(d["v"].map(len)).indices.items():
                u = _unit(np.stack(d["v"].to_numpy()[part]))
                at[part] = u @ axes[n][:, 0] if n in axes else u[:, 0]
            yield pd.DataFrame({"key": d["key"], "at": at})

    spots = classes.select("key", "v").mapInPandas(place, "key long, at double")
    ordered = (classes.join(spots, "key").withColumn("d", F.size("v"))
               .repartitionByRange("label", "d", "at", "key").sortWithinPartitions("label", "d", "at", "key"))
    ordered = ordered.select("label", "d", "at", "key", "m", "v")

    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def tile(p: pd.DataFrame) -> dict:
            return {"label": p["label"].iloc[0], "d": int(p["d"].iloc[0]), "lo": float(p["at"].iloc[0]),
                    "hi": float(p["at"].iloc[-1]), "tile": int(p["key"].iloc[0]),
                    "keys": p["key"].to_numpy(np.int64).tobytes(), "counts": p["m"].to_numpy(np.int64).tobytes(),
                    "vectors": np.stack(p["v"].to_numpy()).astype(np.float64).tobytes()}
        held: pd.DataFrame | None = None
        for d in batches:
            held = d if held is None else pd.concat([held, d], ignore_index=True)
            out, cuts = [], np.flatnonzero((held["label"] != held["label"].shift()) | (held["d"] != held["d"].shift())).tolist() + [len(held)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                last = hi == len(held)
                while hi - lo >= near.tile or (not last and hi > lo):
                    out.append(tile(held.iloc[lo:min(hi, lo + near.tile)]))
                    lo = min(hi, lo + near.tile)
                rest = lo
            held = held.iloc[rest:].reset_index(drop=True) if cuts[:-1] else None
            if out:
                yield pd.DataFrame(out)
        if held is not None and len(held):
            yield pd.DataFrame([tile(held)])

    # a tile is one row of a written table, so a lost task cannot deal its vectors out anew
    tiled = cut(ordered.withColumn("label", F.col("label").cast("string")).mapInPandas(
        tiles, "label string, d int, lo double, hi double, tile long, keys binary, counts binary, vectors binary"), "tiles")

    # unit vectors whose cosine is t lie sqrt(2 - 2t) apart, along any axis at most
    span = float(np.sqrt(max(0.0, 2 - 2 * near.threshold))) + 1e-6
    small = tiled.select("label", "d", "lo", "hi", "tile")
    x = small.select("label", "d", F.col("lo").alias("x_lo"), F.col("hi").alias("x_hi"), F.col("tile").alias("x"), F.explode(
        F.sequence(F.floor(F.col("lo") / span), F.floor((F.col("hi") + span) / span))).alias("cell"))
    y = small.select("label", "d", F.floor(F.col("lo") / span).alias("cell"), F.col("lo").alias("y_lo"), F.col("tile").alias("y"))
    pairs = x.join(y, ["label", "d", "cell"]).where(
        (F.col("y_lo") <= F.col("x_hi") + span)
        & ((F.col("x_lo") < F.col("y_lo")) | ((F.col("x_lo") == F.col("y_lo")) & (F.col("x") <= F.col("y"))))).select("x", "y")
    full = lambda s: tiled.select(F.col("tile").alias(s), F.col("d").alias(f"{s}_d"), F.col("keys").alias(f"{s}_keys"),
                                  F.col("counts").alias(f"{s}_counts"), F.col("vectors").alias(f"{s}_vectors"))
    # every pair of tiles is a unit of work, dealt out evenly
    work = pairs.join(full("x"), "x").join(full("y"), "y").drop("y_d").repartition(F.xxhash64("x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                r = {n: batch.column(k)[at].as_py() for k, n in enumerate(batch.schema.names)}
                same, d = r["x"] == r["y"], r["x_d"]
                a, b = (np.frombuffer(r[f"{s}_vectors"], np.float64).reshape(-1, d) for s in "xy")
                keys_a, keys_b = (np.frombuffer(r[f"{s}_keys"], np.int64) for s in "xy")
                counts_a, counts_b = (np.frombuffer(r[f"{s}_counts"], np.int64) for s in "xy")
                i, j = compare_tiles(a, b, same, axes.get(d), near)
                shift = 0 if same else len(a)
                keys = keys_a if same else np.concatenate((keys_a, keys_b))
                counts = counts_a if same else np.concatenate((counts_a, counts_b))
                links = np.zeros(len(keys), np.int64)
                np.add.at(links, i, counts[j + shift])
                np.add.at(links, j + shift, counts[i])
                low = reach(len(keys), i, j + shift)
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), pa.array(keys[low[hit]]), pa.array(links[hit])],
                                                 names=["key", "low", "n"])

    found = cut(work.mapInArrow(run, "key long, low long, n long"), "linked")
    links = found.groupBy("key").agg(F.sum("n").alias("n"))
    member = components(found.select(F.col("key").alias("a"), F.col("low").alias("b")), "vectors")
    known = (classes.select("key", "label", "v", "rep", "m")
             .join(links, "key", "left").join(member.withColumnRenamed("id", "key"), "key", "left"))
    known = known.withColumn("component", F.coalesce("component_id", "key"))
    least = known.groupBy("component").agg(F.min("rep").alias("least"))
    known = known.join(least, "component").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n"), "least")
    out = rows.join(known, F.col("links") & (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("least", "vec_id").alias("component_id")).select(
        "*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
