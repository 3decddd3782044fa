"""Skew-safe ordered computations per key: running sums and sliding frames.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task.  When one camera holds a third of all rows (for instance many tiny
batches), that task holds a third of the data.  Both helpers below keep every
partition bounded:

* ``running_sums``: parallel prefix sum.  Rows are cut into chunks by a
  monotone chunk id (e.g. ``batch_round div C``); each (key, chunk) computes
  local running sums, the last of which is the chunk's total; a small table of
  totals gets its own running sum (one row per chunk), joined back.
* ``halo_window``: sliding frames over an integer position.  Rows are chunked
  by position, and a row among the last ``span`` positions of its chunk is
  also a halo row of the next (one ``explode``), so a frame
  ``rangeBetween(-span, 0)`` is computed per (key, chunk).  Halo rows are
  dropped from the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, part: str, order: list, chunk: Column,
                 sums: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums ``{name: expr}`` of non-negative values per
    ``part`` in ``order`` (column names or expressions).

    ``chunk`` must be non-decreasing along ``order`` within a part.
    """
    local = Window.partitionBy(part, "_chunk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("_chunk", chunk).withColumns({f"_l_{k}": F.sum(v).over(local) for k, v in sums.items()})
    totals = d.groupBy(part, "_chunk").agg(*[F.max(f"_l_{k}").alias(f"_t_{k}") for k in sums])
    before = Window.partitionBy(part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, "_chunk", *[
        F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    d = d.join(offsets, [part, "_chunk"], "left")
    return d.withColumns({k: F.col(f"_l_{k}") + F.coalesce(F.col(f"_o_{k}"), F.lit(0)) for k in sums}) \
            .drop("_chunk", *[f"_l_{k}" for k in sums], *[f"_o_{k}" for k in sums])


def halo_chunks(df: DataFrame, pos: str, span: int, chunk_size: int) -> DataFrame:
    """``df`` with ``_hc``, the chunk of a position, and ``_halo``: 0, or 1 for the copy of a
    row among the last ``span`` positions of a chunk that the next chunk reads."""
    if chunk_size <= span:
        raise ValueError("chunk_size must exceed the frame span")
    p = F.col(pos) - F.lit(1)
    home = F.floor(p / F.lit(chunk_size)).cast("long")
    chunks = F.when(F.pmod(p, F.lit(chunk_size)) >= F.lit(chunk_size - span), F.array(home, home + 1)) \
              .otherwise(F.array(home))
    return df.select("*", F.posexplode(chunks).alias("_halo", "_hc"))


def halo_window(df: DataFrame, part: str, pos: str, span: int, chunk_size: int,
                frame_cols: dict[str, object]) -> DataFrame:
    """Compute ``frame_cols`` (name -> fn(window) -> Column) over the frame
    ``pos in [cur - span, cur]`` per ``part``, with bounded partitions."""
    both = halo_chunks(df, pos, span, chunk_size)
    w = Window.partitionBy(part, "_hc").orderBy(pos).rangeBetween(-span, 0)
    out = both.withColumns({name: fn(w) for name, fn in frame_cols.items()})
    return out.where(F.col("_halo") == 0).drop("_hc", "_halo")
