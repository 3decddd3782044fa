"""Drift detection: baseline model, sliding windows, grouped KS and centroids.

Plan shape (README "Scale design"):

1. ``batch_rows``: only the last ``W`` valid rows of each (feed, round) batch
   can ever sit in a window, so a ``row_number() <= W`` filter runs first,
   planned as a WindowGroupLimit on both sides of the one shuffle of rows.
   Norms and baseline counts are computed for the kept rows only, which then
   become one array per batch.
2. ``drift_windows``: the arrays of a camera pass in order, per position chunk with a
   halo of W - 1 positions, so no task holds a whole camera.  A window keeps three numbers
   a row with their baseline counts; of the embeddings it keeps their sum, carried along
   by ``SlidingSum``, so its cost does not grow with W times the dimension.
3. KS statistic per window and feature with integer counts, one sort a window; baseline
   counts come from a binary search (``aggregate`` halving steps) into the fitted
   baseline arrays, which are one-row scalar subqueries: no join.
4. p-values by a pandas UDF that computes each distinct (n1, n2, ks_num) once per worker.
5. Status per batch from the batch table (running valid count per camera).

The baseline is the first ``baseline_samples`` valid rows of a stated
reference period.  It is fitted by aggregations: counts of distinct values per
feature and the mean of every embedding position.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import GateConfig
from ..functions.ks import exact_pvalue_expr, ks_num_expr, large_sample_pvalue_expr
from ..session import share_package
from ..sources import topology
from .ordered import halo_chunks, running_sums

# window struct field per drift feature (embedding drift is KS on L2 norms)
FIELD = {"brightness_avg": "b", "blur_metric": "l", "embedding": "n"}
KEYS = ["feed_id", "batch_round", "seq"]
#: what a window keeps of a row
POINT = ("seq", "b", "b_ble", "b_blt", "l", "l_ble", "l_blt", "n", "n_ble", "n_blt")
POINT_TYPE = "struct<pos:bigint,seq:bigint," + ",".join(f"{f}:double,{f}_ble:bigint,{f}_blt:bigint" for f in "bln") + ">"


def norm_expr(col: str | Column) -> Column:
    """K5: L2 norm as a left fold over the elements; null with a null element."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x))


def baseline_rows(valid: DataFrame, cfg: GateConfig, max_round: int | None = None,
                  n: int | None = None) -> DataFrame:
    """The reference sample — the first ``n`` valid rows of a reference
    period, by (seq, feed, round), so several feeds with their own ``seq`` give
    one answer.  Only keys are ranked (a top-n per partition, then of those);
    the wide rows are looked up for the n chosen ones."""
    src = valid if max_round is None else valid.where(F.col("batch_round") <= max_round)
    chosen = src.select(*KEYS).orderBy("seq", "feed_id", "batch_round").limit(n or cfg.baseline_samples)
    return src.join(chosen.distinct(), KEYS, "left_semi")


@dataclass
class BaselineModel:
    """Sorted distinct values with cumulative counts per feature; None for a
    feature with a missing or NaN value (no statistic is defined then)."""
    n2: int
    values: dict[str, list[float] | None]
    cum_le: dict[str, list[int] | None]
    centroid: list[float]
    centroid_norm: float

    @classmethod
    def fit(cls, baseline: DataFrame, cfg: GateConfig) -> "BaselineModel":
        """Exact counts by aggregation; what reaches the driver is at most one
        row per distinct value of the sample and one per embedding position."""
        rows = baseline.select(F.col("brightness_avg").alias("b"), F.col("blur_metric").alias("l"),
                               norm_expr("embedding").alias("n"), "embedding")
        points = rows.select(F.explode(F.array(*[
            F.struct(F.lit(f).alias("f"), F.col(f).alias("x")) for f in FIELD.values()])).alias("p")).select("p.*")
        counts = points.groupBy("f", "x").agg(F.count(F.lit(1)).alias("c")).collect()
        n2 = sum(r["c"] for r in counts if r["f"] == "b")
        if not n2:
            raise ValueError("empty baseline")
        values, cums = {}, {}
        for f in FIELD.values():
            own = [(r["x"], r["c"]) for r in counts if r["f"] == f]
            if any(x is None or math.isnan(x) for x, _ in own):
                values[f] = cums[f] = None
                continue
            own.sort()
            values[f], cums[f] = [x for x, _ in own], [0]
            for _, c in own:
                cums[f].append(cums[f][-1] + c)
        means = (rows.select(F.posexplode("embedding").alias("pos", "x")).groupBy("pos")
                 .agg(F.when(F.count("x") == F.count(F.lit(1)), F.avg("x")).alias("m")).orderBy("pos").collect())
        centroid = [float("nan") if r["m"] is None else r["m"] for r in means]
        return cls(n2=n2, values=values, cum_le=cums, centroid=centroid,
                   centroid_norm=math.sqrt(sum(x * x for x in centroid)))

    def lookup(self, spark: SparkSession) -> Column:
        """The fitted arrays as a scalar subquery over one row: a struct of the
        sorted distinct values and cumulative counts of every feature."""
        names = [f for f in FIELD.values() if self.values[f] is not None]
        schema = ", ".join(f"{f}_vals array<double>, {f}_cum array<bigint>" for f in names)
        row = [x for f in names for x in (self.values[f], self.cum_le[f])]
        return spark.createDataFrame([row], schema).select(F.struct("*")).scalar()

    def annotate(self, df: DataFrame) -> DataFrame:
        """Add ``{f}_ble`` / ``{f}_blt`` (# baseline <= x / < x) for b, l, n.

        ``idx`` = number of distinct baseline values <= x, found by a binary
        search written as ``aggregate`` over ceil(log2(m+1)) halving steps; the
        cumulative counts at ``idx`` (and at ``idx-1`` when x equals a baseline
        value) give both counts.  A feature without a fitted table gets nulls."""
        flds = list(FIELD.values())
        known = [f for f in flds if self.values[f] is not None]
        out = df.withColumn("_lookup", self.lookup(df.sparkSession)) if known else df
        idx_cols, count_cols = {}, {}
        for f in flds:
            if f not in known:
                count_cols |= {f"{f}_ble": F.lit(None).cast("bigint"), f"{f}_blt": F.lit(None).cast("bigint")}
                continue
            vals, cum, x = F.col(f"_lookup.{f}_vals"), F.col(f"_lookup.{f}_cum"), F.col(f)
            idx_cols[f"_{f}_idx"] = F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int")) \
                                     .otherwise(_binary_search(vals, len(self.values[f]), x))
            idx = F.col(f"_{f}_idx")
            le = F.element_at(cum, idx + 1)
            at_value = (idx >= 1) & (F.element_at(vals, F.greatest(idx, F.lit(1))) == x)
            count_cols[f"{f}_ble"] = le
            count_cols[f"{f}_blt"] = F.when(at_value, F.element_at(cum, idx)).otherwise(le)
        return out.withColumns(idx_cols).withColumns(count_cols).drop("_lookup", *idx_cols)


def _binary_search(vals: Column, m: int, x: Column) -> Column:
    """Number of elements of the sorted array ``vals`` (length m) <= x."""
    steps = max(1, math.ceil(math.log2(m + 1)))

    def step(st, _i):
        lo, hi = st["lo"], st["hi"]
        mid = ((lo + hi + F.lit(1)) / F.lit(2)).cast("int")
        go_right = F.element_at(vals, F.greatest(mid, F.lit(1))) <= x
        return (F.when(lo >= hi, st)
                 .when(go_right, F.struct(mid.alias("lo"), hi.alias("hi")))
                 .otherwise(F.struct(lo.alias("lo"), (mid - F.lit(1)).alias("hi"))))

    init = F.struct(F.lit(0).alias("lo"), F.lit(m).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]


def double_array_lit(values) -> Column:
    """Array literal in ONE expression (a py4j call per element is slow).  ``repr`` is the shortest round-trip
    text, and the ``D`` suffix parses it as an exact double."""
    if not values:
        return F.array().cast("array<double>")
    return F.expr("array(" + ", ".join("double('NaN')" if math.isnan(v) else f"double('{float(v)!r}')" if math.isinf(v)
                                       else f"{float(v)!r}D" for v in values) + ")")


def last_rows_per_batch(valid: DataFrame, w: int) -> DataFrame:
    """The last ``w`` valid rows of each batch with ``_r``, the rank from the
    batch end (1 = last row).  Planned as a partial WindowGroupLimit before
    the shuffle plus a final one after it."""
    order = Window.partitionBy("feed_id", "batch_round").orderBy(F.col("seq").desc())
    return (valid.select("feed_id", "batch_round", "seq", "brightness_avg", "blur_metric", "embedding")
            .withColumn("_r", F.row_number().over(order))
            .where(F.col("_r") <= w))


def _contributing(batches: DataFrame, cfg: GateConfig) -> DataFrame:
    """Batches of known cameras with valid rows, and the camera's count at their end."""
    return (drift_buffer(batches, cfg).where(F.col("valid_count") > 0)
            .select("feed_id", "batch_round", "camera_id", "buffer_total"))


class SlidingSum:
    """Sum of the vectors of the last ``width`` positions, from blocks of ``width`` positions: a
    window is the end of one block (suffix sums, made when the block is complete) and the start of
    the next (a running sum).  Nothing is ever subtracted, so a large or infinite vector is gone
    when its row is; blocks are places of the stream, so the result does not depend on
    where a task begins; a step costs two additions."""

    def __init__(self, width: int) -> None:
        self.width, self.block = width, None
        self.old: list[tuple[int, np.ndarray]] = []      # (position, sum from there to the block's end), last first
        self.new: list[tuple[int, np.ndarray]] = []
        self.new_sum: np.ndarray | None = None

    def push(self, pos: int, vector: np.ndarray) -> None:
        block = (pos - 1) // self.width
        if block != self.block:
            self.old, total = [], None
            if self.block is not None and block == self.block + 1:
                for at, v in reversed(self.new):
                    total = v if total is None else v + total
                    self.old.append((at, total))
            self.block, self.new, self.new_sum = block, [], None
        self.new.append((pos, vector))
        self.new_sum = vector if self.new_sum is None else self.new_sum + vector

    def total(self, end: int) -> np.ndarray | None:
        """Of the window that ends at ``end``, the last position pushed."""
        while self.old and self.old[-1][0] <= end - self.width:
            self.old.pop()
        return self.old[-1][1] + self.new_sum if self.old else self.new_sum


def point_columns(model: "BaselineModel", rows: DataFrame, *more: str) -> DataFrame:
    """Rows as points of a window: the three numbers with their baseline counts."""
    return model.annotate(rows.select(
        "feed_id", "batch_round", "seq", *more, F.col("brightness_avg").alias("b"),
        F.col("blur_metric").alias("l"), norm_expr("embedding").alias("n"), "embedding"))


def drift_windows(valid: DataFrame, batches: DataFrame, model: BaselineModel, cfg: GateConfig) -> DataFrame:
    """For every batch of a known camera with valid rows, the window of
    the camera's last W valid rows as of the batch end (spanning batches): ``win``, its
    points in order, and ``centre``, the sum of its embeddings (null if one is incomplete)."""
    w, dim = cfg.drift_window, cfg.embedding_dim
    share_package(valid.sparkSession)
    # one array per batch: the shuffle of the row limit serves the grouping too
    arrays = point_columns(model, last_rows_per_batch(valid, w), "_r").groupBy("feed_id", "batch_round").agg(
        F.collect_list(F.struct("_r", *POINT, "embedding")).alias("rows"))
    ends = arrays.join(_contributing(batches, cfg), ["feed_id", "batch_round"]).select(
        "camera_id", "feed_id", "batch_round", F.col("buffer_total").cast("bigint").alias("end"),
        F.transform("rows", lambda r: F.struct((F.col("buffer_total") - r["_r"] + 1).cast("bigint").alias("pos"),
                                               *[r[f].alias(f) for f in (*POINT, "embedding")])).alias("rows"))
    ends = halo_chunks(ends, "end", w - 1, cfg.chunk_positions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, total = None, None, SlidingSum(w)
        for batch in batches:
            lists = batch.column("rows")
            flat, sizes = lists.flatten(), lists.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((flat.field("pos").to_numpy(), row))
            flat = flat.take(pa.array(order))
            vectors = _matrix(flat.field("embedding"), dim)
            points = pa.StructArray.from_arrays([flat.field(f) for f in ("pos", *POINT)], names=["pos", *POINT])
            carried = 0 if held is None else len(held)
            pool = points if held is None else pa.concat_arrays([held, points])
            pos = pool.field("pos").to_numpy()
            stops = carried + np.cumsum(sizes)
            start, picks, centres, wanted = 0, [], [], []
            keys = list(zip(batch.column("camera_id").to_pylist(), batch.column("_hc").to_pylist()))
            for k, (key, end, halo) in enumerate(zip(keys, batch.column("end").to_pylist(), batch.column("_halo").to_pylist())):
                lo, hi = int(stops[k] - sizes[k]), int(stops[k])
                if key != group:
                    group, total, start = key, SlidingSum(w), lo
                for x in range(lo, hi):
                    total.push(int(pos[x]), vectors[x - carried])
                start += int(np.searchsorted(pos[start:hi], end - w, side="right"))
                if not halo:
                    wanted.append(k)
                    picks.append((start, hi))
                    centres.append(total.total(end))
            if wanted:
                offsets = np.concatenate(([0], np.cumsum([hi - lo for lo, hi in picks])))
                rows = np.concatenate([np.arange(lo, hi) for lo, hi in picks])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(wanted)) for c in ("camera_id", "feed_id", "batch_round")]
                    + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pool.take(pa.array(rows))),
                       pa.array([None if c is None or np.isnan(c).any() else c for c in centres], pa.list_(pa.float64()))],
                    names=["camera_id", "feed_id", "batch_round", "win", "centre"])
            held = pool.slice(start)

    types = dict(ends.dtypes)
    ordered = ends.repartition("camera_id", "_hc").sortWithinPartitions("camera_id", "_hc", "end", "feed_id", "batch_round")
    return ordered.mapInArrow(run, f"camera_id {types['camera_id']}, feed_id {types['feed_id']}, batch_round {types['batch_round']}, "
                                   f"win array<{POINT_TYPE}>, centre array<double>")


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    """Embeddings as rows; a missing element, or another length, makes a row of NaN."""
    sizes, values = lists.value_lengths().fill_null(0).to_numpy(), lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return values.reshape(-1, dim)
    out, ends = np.full((len(sizes), dim), np.nan), np.cumsum(sizes)
    for k in np.flatnonzero(sizes == dim):
        out[k] = values[ends[k] - dim:ends[k]]
    return out


def centroid_exprs(model: BaselineModel, cfg: GateConfig) -> dict[str, Column]:
    """K6/K7: centroid cosine similarity and euclidean distance (M20) of windows with
    ``win`` and ``centre``, the sum of their embeddings."""
    if not model.centroid:
        return {"mean_cosine_similarity": F.lit(1.0), "mean_euclidean_distance": F.lit(0.0)}
    bc = double_array_lit(model.centroid)
    wc = F.transform("centre", lambda x: x / F.size("win"))
    dot = F.aggregate(F.zip_with(wc, bc, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    nw = F.sqrt(F.aggregate(wc, F.lit(0.0), lambda a, x: a + x * x))
    cos_dist = F.lit(1.0) - dot / (nw * F.lit(model.centroid_norm))
    euclid = F.sqrt(F.aggregate(F.zip_with(wc, bc, lambda x, y: (x - y) * (x - y)),
                                F.lit(0.0), lambda a, x: a + x))
    empty = F.size("win") == 0
    return {"mean_cosine_similarity": F.when(empty, F.lit(1.0)).otherwise(F.lit(1.0) - cos_dist),
            "mean_euclidean_distance": F.when(empty, F.lit(0.0)).otherwise(euclid)}


def statistics_columns(model: BaselineModel, cfg: GateConfig) -> dict[str, Column]:
    """K1 + K6/K7 of ``win`` and ``centre``: sizes, ks_num per feature and centroid metrics."""
    cols = {"n1": F.size("win").cast("bigint"), "n2": F.lit(model.n2).cast("bigint")}
    for feat, fld in FIELD.items():
        cols[f"{feat}_ks_num"] = ks_num_expr("win", fld, model.n2)
    return cols | centroid_exprs(model, cfg)


def window_statistics(windows: DataFrame, model: BaselineModel, cfg: GateConfig) -> DataFrame:
    """The statistics of full windows."""
    return (windows.where(F.size("win") >= cfg.drift_window)
            .withColumns(statistics_columns(model, cfg)).drop("win", "centre"))


def with_pvalues(stats: DataFrame, cfg: GateConfig, ks_nums: dict[str, str]) -> DataFrame:
    """K2/K3: ``stats`` with a p-value column for each statistic column of ``ks_nums``;
    exact up to ``exact_ks_max_n`` values a sample."""
    exact = F.greatest("n1", "n2") <= F.lit(cfg.exact_ks_max_n)
    # each of the two functions is given its own rows only, nulls for the others
    out = stats.withColumns({f"_{p}_ks": F.when(exact, F.col(ks)) for ks, p in ks_nums.items()} | {
        f"_{p}_d": F.when(~exact, F.col(ks).cast("double") / (F.col("n1") * F.col("n2"))) for ks, p in ks_nums.items()})
    out = out.withColumns({p: F.coalesce(exact_pvalue_expr(kn=f"_{p}_ks"), large_sample_pvalue_expr(f"_{p}_d")) for p in ks_nums.values()})
    return out.select(*stats.columns, *ks_nums.values())


def pvalue_table(stats: DataFrame, cfg: GateConfig) -> DataFrame:
    """p-value per distinct (n1, n2, ks_num) of any feature."""
    triples = stats.select("n1", "n2", F.explode(F.array(*[f"{f}_ks_num" for f in FIELD])).alias("ks_num")) \
        .where("ks_num is not null").distinct()
    d = F.col("ks_num").cast("double") / (F.col("n1") * F.col("n2"))
    return with_pvalues(triples.withColumn("ks_statistic", d), cfg, {"ks_num": "p_value"})


def flagged(stats: DataFrame, cfg: GateConfig) -> DataFrame:
    """K2..K4 + K9 on each window: statistic, p-value and flags.  Rows stay wide."""
    out = stats.withColumns({f"{f}_ks": F.col(f"{f}_ks_num").cast("double") / (F.col("n1") * F.col("n2")) for f in FIELD})
    out = with_pvalues(out, cfg, {f"{f}_ks_num": f"{f}_p" for f in FIELD})
    flags = {f"{f}_drift": F.coalesce(F.col(f"{f}_p") < F.lit(cfg.drift_alpha), F.lit(False)) for f in FIELD}
    return out.withColumns(flags).withColumn("drift_detected", F.expr(" or ".join(f"{f}_drift" for f in FIELD)))


def drift_buffer(batches: DataFrame, cfg: GateConfig) -> DataFrame:
    """Running count of valid rows per known batch camera (M17), as a
    chunked prefix sum over the batch table (bounded partitions per camera)."""
    known = topology.with_place(topology.known_rows(batches, "camera_id", cfg), cfg)
    return running_sums(known, "camera_id", topology.stream_order(),
                        F.floor(F.col("batch_round") / F.lit(cfg.chunk_rounds)),
                        {"buffer_total": F.col("valid_count")}).drop(topology.PLACE)


def status_columns(cfg: GateConfig, known: Column) -> dict[str, Column]:
    """W4 from ``valid_count`` and ``buffer_total``: status, reason, buffer size; empty
    input is tested before an unknown camera (M15), then buffering until W rows exist (M16)."""
    empty, buf = F.col("valid_count") == 0, F.col("buffer_total")
    few = buf < cfg.drift_window
    size = F.when(empty, F.when(known, buf).otherwise(F.lit(0))).when(~known, F.lit(None)).when(few, buf)
    return {
        "status": (F.when(empty, F.lit("skipped")).when(~known, F.lit("skipped"))
                   .when(few, F.lit("buffering")).otherwise(F.lit("analyzed"))),
        "reason": F.when(empty, F.lit("empty_input")).when(~known, F.lit("unknown_camera")),
        "buffer_size": size.cast("bigint")}


def drift_status(batches: DataFrame, cfg: GateConfig) -> DataFrame:
    """Report status per batch."""
    unknown = topology.unknown_rows(batches, "camera_id", cfg).withColumn("buffer_total", F.lit(None).cast("bigint"))
    found = {k: v.alias(k) for k, v in status_columns(cfg, F.col("_known")).items()}
    return drift_buffer(batches, cfg).withColumn("_known", F.lit(True)).unionByName(unknown.withColumn("_known", F.lit(False))).select(
        "feed_id", "batch_round", "camera_id", "valid_count", *found.values())


def report_columns(reports: DataFrame, cfg: GateConfig) -> DataFrame:
    """What a report has of its window once its ``status`` is known."""
    analyzed = F.col("status") == "analyzed"
    out = reports.withColumns({
        "window_size": F.when(analyzed, F.col("n1").cast("int")),
        "drift_detected": analyzed & F.coalesce("drift_detected", F.lit(False)),
        "alpha": F.when(analyzed, F.lit(cfg.drift_alpha)),
    })
    return out.withColumn("features", F.when(analyzed, features_map()))


def drift_reports(valid: DataFrame, batches: DataFrame, model: BaselineModel, cfg: GateConfig) -> DataFrame:
    """One drift report per batch, wide and with its ``features`` map."""
    stats = window_statistics(drift_windows(valid, batches, model, cfg), model, cfg)
    reports = flagged(stats, cfg).drop("camera_id")
    return report_columns(drift_status(batches, cfg).join(reports, ["feed_id", "batch_round"], "left"), cfg)


def drift_features(reports: DataFrame) -> DataFrame:
    """Long form: one row per analyzed report and feature."""
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"{f}_ks_num").alias("ks_num"),
                     F.col(f"{f}_ks").alias("ks_statistic"), F.col(f"{f}_p").alias("p_value"),
                     F.col(f"{f}_drift").alias("drift_detected")) for f in C.DRIFT_FEATURES]
    return (reports.where(F.col("status") == "analyzed")
            .select("feed_id", "batch_round", "camera_id", "n1", "n2",
                    "mean_cosine_similarity", "mean_euclidean_distance",
                    F.explode(F.array(*rows)).alias("f"))
            .select("feed_id", "batch_round", "camera_id", "n1", "n2", "f.*",
                    "mean_cosine_similarity", "mean_euclidean_distance"))


def drift_alerts(reports: DataFrame) -> DataFrame:
    """One alert row per drifted feature of an analyzed report."""
    return drift_features(reports).where(F.col("drift_detected"))


def features_map() -> Column:
    """The ``features`` map of a report (K10, I3): metrics by feature; the
    centroid metrics belong to the embedding."""
    none = F.lit(None).cast("double")

    def one(f: str) -> Column:
        own = f == "embedding"
        return F.struct(
            F.col(f"{f}_ks").alias("ks_statistic"), F.col(f"{f}_p").alias("p_value"),
            (F.col("mean_cosine_similarity") if own else none).alias("mean_cosine_similarity"),
            (F.col("mean_euclidean_distance") if own else none).alias("mean_euclidean_distance"),
            F.col(f"{f}_drift").alias("drift_detected"))
    return F.create_map(*[x for f in C.DRIFT_FEATURES for x in (F.lit(f), one(f))])


def tail_per_camera(valid: DataFrame, batches: DataFrame, cfg: GateConfig, n: int | None = None) -> DataFrame:
    """O2: last ``n`` valid rows per known batch camera over the whole history.

    Positions come from the chunked prefix sums.  A batch holds rows of the
    tail only if fewer than n rows come after it, so those batches are picked
    first and only their rows are ranked."""
    n = n or cfg.drift_window
    totals = (topology.known_rows(batches, "camera_id", cfg).groupBy("camera_id")
              .agg(F.sum("valid_count").alias("_total")))
    last = (_contributing(batches, cfg).join(totals, "camera_id")
            .where(F.col("_total") - F.col("buffer_total") < n))
    near = valid.join(last.select("feed_id", "batch_round"), ["feed_id", "batch_round"], "left_semi")
    rows = last_rows_per_batch(near, n).join(last, ["feed_id", "batch_round"])
    rank = F.col("_total") - F.col("buffer_total") + F.col("_r")
    return (rows.where(rank <= n)
            .select("camera_id", "feed_id", "batch_round", "seq", rank.cast("int").alias("rank_from_end")))
