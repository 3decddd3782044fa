"""Connected components of a table of links, by alternating star contractions.

In the large star every node points its larger neighbours to the smallest node
it knows; in the small star every node points its smaller neighbours, and
itself, there.  When nothing changes, each link goes from a node to the smallest
of its component.  Every step is two aggregations and two joins; a node with
very many links is only ever a join key, which adaptive execution splits, and
links are never gathered.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (a, b) with a > b."""
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links.unionByName(back) if large else links
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    if large:
        # every larger neighbour of a goes to the least of a and its neighbours
        moved = back.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``links`` has long columns a, b in any order.  Returns (id, component_id) of
    every node that has a link; component_id is the smallest id it can reach."""
    now = cut(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    before = None
    step = 0
    while True:
        step += 1
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        now = cut(_star(_star(now, True), False), f"{name}-{step}")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


def reach(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches by the pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
