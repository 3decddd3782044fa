"""Structured Streaming: the QA gate (W8) and stateful drift + breaker.

W8 is stateless: the same ``evaluate_rules`` projection runs on every
micro-batch and the split goes to file sinks.

W9 is one append query whose state lives in Spark's state store, by key, so a
micro-batch touches only the feeds and cameras that it holds:

* ``Batches`` (by feed): a batch that arrives in pieces is kept as a mergeable partial
  (counts, first row, last event time, last W valid rows) until it has
  ``frames_per_batch`` rows.  Rounds of a feed leave in order; a later round that is
  complete first is held.  Without that setting the source delivers whole batches
  per micro-batch (e.g. one file per round) and nothing is kept.
* ``Cameras`` (by camera): the last W valid rows, the running valid count and the last
  N - 1 QA records; one row per batch leaves with its window and rolling counts.
* Statistics, p-values, flags and status are the expressions of the batch operators,
  applied to those rows.
* ``Latch`` (by camera): the number of trips so far.

The file sink writes one row per batch exactly once (``evaluated``); every output
table is a projection of it (``read``).  Recovery, replays and old state versions are the
engine's; there is nothing of our own to commit.

Batches of one camera are taken in the order (round, configured feed order) within a
micro-batch, and micro-batches in the order of arrival.  Rows of a round that has
already left its feed change nothing here; W8's tables hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .. import config as C
from ..config import GateConfig
from ..functions.rules import contract_violations
from ..functions.text import parse_utc, utc_text
from ..operators import breaker, drift, incidents, qa, summary
from ..session import share_package
from ..sources import topology

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
POINT = ("seq", *drift.POINT[1:], "embedding")
_TYPES = {"seq": "bigint", "embedding": "array<double>"} | {f: "double" for f in "bln"}
POINTS = "array<struct<" + ",".join(f"{c}:{_TYPES.get(c, 'bigint')}" for c in POINT) + ">>"
PARTIAL = f"frames bigint, valid bigint, quarantined bigint, first_seq bigint, camera_id string, micros bigint, points {POINTS}"
BATCH = f"feed_id string, batch_round bigint, camera_id string, valid_count bigint, quarantined_count bigint, micros bigint, points {POINTS}"
#: a report's numbers by feature
FEATURE_COLUMNS = [f"{f}_{x}" for f in C.DRIFT_FEATURES for x in ("ks_num", "ks", "p", "drift")]
REPORT = ["status", "reason", "buffer_size", "n1", "n2", *FEATURE_COLUMNS, "mean_cosine_similarity", "mean_euclidean_distance", "drift_detected"]
#: what the breaker takes from the last report of a camera's round
LAST = ["status", "n1", *[c for c in FEATURE_COLUMNS if not c.endswith("ks_num")], "mean_cosine_similarity", "mean_euclidean_distance", "drift_detected"]


def gate_stream(frames_stream: DataFrame, cfg: GateConfig) -> DataFrame:
    """The quality gate on a streaming DataFrame (stateless)."""
    return qa.gate(frames_stream, cfg)


def start_gate_sinks(frames_stream: DataFrame, cfg: GateConfig, valid_path: str,
                     quarantine_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """W8 + S8: one query, so the source is read once; each micro-batch is gated
    once and split into a folder of its own in both tables, which a replay
    overwrites with the same rows."""
    def write(batch: DataFrame, epoch: int) -> None:
        gated = gate_stream(batch, cfg).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for rows, path in ((qa.valid_frames(gated), valid_path), (qa.quarantined_frames(gated), quarantine_path)):
                rows.write.mode("overwrite").partitionBy("batch_round").parquet(f"{path.rstrip('/')}/epoch={epoch}")
        finally:
            gated.unpersist()

    return (frames_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _whole(x: Any) -> int | None:
    """A number of a pandas column with missing values, as a state takes it."""
    return None if x is None or pd.isna(x) else int(x)


def _point(p: Any) -> tuple:
    """A point from a dict (of pandas) or a row (of the state)."""
    values = [p[c] for c in POINT] if isinstance(p, dict) else p
    return tuple([float(x) for x in v] if c == "embedding" else float(v) if c in "bln" else _whole(v) for c, v in zip(POINT, values))


def _points(points: list[tuple]) -> list[dict]:
    return [dict(zip(POINT, p)) for p in points]


class Batches(StatefulProcessor):
    """Rows of a feed to batches; see the module's notes."""

    def __init__(self, window: int, frames_per_batch: int | None, first_round: int):
        self.window, self.frames, self.first_round = window, frames_per_batch, first_round

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.partial = handle.getMapState("partial", "batch_round bigint", PARTIAL)
        self.next = handle.getValueState("next", "batch_round bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        found: dict[int, tuple] = {}
        for d in rows:
            for r, part in d.groupby("batch_round"):
                found[int(r)] = self._merge(found.get(int(r)), self._partial(part))
        if self.frames is None:
            out = sorted(found.items())
        else:
            out, at = [], self.next.get()[0] if self.next.exists() else self.first_round
            for r, new in found.items():
                if r >= at:
                    self.partial.updateValue((r,), self._merge(tuple(self.partial.getValue((r,))) if self.partial.containsKey((r,)) else None, new))
            while self.partial.containsKey((at,)) and self.partial.getValue((at,))[0] >= self.frames:
                out.append((at, tuple(self.partial.getValue((at,)))))
                self.partial.removeKey((at,))
                at += 1
            self.next.update((at,))
        if out:
            yield pd.DataFrame([(key[0], r, p[4], p[1], p[2], p[5], _points([_point(x) for x in p[6]])) for r, p in out],
                               columns=["feed_id", "batch_round", "camera_id", "valid_count", "quarantined_count", "micros", "points"])

    def _partial(self, d: pd.DataFrame) -> tuple:
        first = d.loc[d["seq"].idxmin()]
        valid = d[d["is_valid"]].nlargest(self.window, "seq").sort_values("seq")
        return (len(d), int(d["is_valid"].sum()), int((~d["is_valid"]).sum()), int(first["seq"]), first["camera_id"],
                _whole(d["micros"].max()), [_point(p) for p in valid[list(POINT)].to_dict("records")])

    def _merge(self, a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        points = sorted((_point(x) for x in [*a[6], *b[6]]), key=lambda p: p[0])[-self.window:]
        least = min(a, b, key=lambda p: p[3])
        micros = [m for m in (a[5], b[5]) if m is not None]
        return a[0] + b[0], a[1] + b[1], a[2] + b[2], least[3], least[4], max(micros, default=None), points

    def close(self) -> None:
        pass


CAMERA = (f"camera_id string, feed_id string, batch_round bigint, place int, known boolean, valid_count bigint, quarantined_count bigint, micros bigint, "
          f"buffer_total bigint, rolling_q bigint, rolling_t bigint, win {POINTS.replace(',embedding:array<double>', '')}, centre array<double>")


class Cameras(StatefulProcessor):
    """Batches of a camera to windows and rolling counts."""

    def __init__(self, window: int, records: int):
        self.window, self.keep = window, records

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.points = handle.getListState("points", ", ".join(f"{c} {_TYPES.get(c, 'bigint')}" for c in POINT))
        self.records = handle.getListState("records", "total bigint, quarantined bigint")
        self.count = handle.getValueState("count", "valid bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["batch_round", "place", "feed_id"])
        if not d["known"].iloc[0]:     # no state for cameras outside the topology
            yield d.drop(columns="points").assign(buffer_total=None, rolling_q=None, rolling_t=None, win=None, centre=None)[_names(CAMERA)]
            return
        points = [_point(p) for p in self.points.get()] if self.points.exists() else []
        records = [tuple(r) for r in self.records.get()] if self.records.exists() else []
        count, out = self.count.get()[0] if self.count.exists() else 0, []
        for r in d.to_dict("records"):
            count += int(r["valid_count"])
            points = (points + [_point(p) for p in r["points"]])[-self.window:]
            records = (records + [(int(r["valid_count"] + r["quarantined_count"]), int(r["quarantined_count"]))])[-self.keep:]
            full = r["valid_count"] > 0 and count >= self.window
            out.append((key[0], r["feed_id"], r["batch_round"], r["place"], True, r["valid_count"], r["quarantined_count"], _whole(r["micros"]), count,
                        sum(q for _, q in records), sum(t for t, _ in records),
                        [{c: v for c, v in x.items() if c != "embedding"} for x in _points(points)] if full else None,
                        np.sum([p[-1] for p in points], axis=0).tolist() if full else None))
        self.points.put(points) if points else self.points.clear()
        self.records.put(records[1 - self.keep:]) if self.keep > 1 else self.records.clear()
        self.count.update((count,))
        yield pd.DataFrame(out, columns=_names(CAMERA))

    def close(self) -> None:
        pass


class Latch(StatefulProcessor):
    """Numbers the trips of a camera; the last report of a round stands for all its records."""

    def __init__(self, cfg: GateConfig, names: list[str]):
        self.threshold, self.features, self.names = cfg.rate_threshold, cfg.min_drift_features, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.trips = handle.getValueState("trips", "trips bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["batch_round", "place", "feed_id"]).reset_index(drop=True)
        last = d.groupby("batch_round").tail(1).set_index("batch_round")[LAST].add_prefix("last_")
        d = d.join(last, on="batch_round")
        if not d["known"].iloc[0]:
            yield d.assign(trips=None)[self.names]
            return
        trips, numbers = self.trips.get()[0] if self.trips.exists() else 0, []
        for r in d.to_dict("records"):
            rate = r["rolling_q"] / r["rolling_t"] if r["rolling_t"] else 0.0
            drifted = r["last_status"] == "analyzed" and bool(r["last_drift_detected"])
            many = drifted and sum(bool(r[f"last_{f}_drift"]) for f in C.DRIFT_FEATURES) >= self.features
            trips += rate > self.threshold or many
            numbers.append(int(trips))
        self.trips.update((int(trips),))
        yield d.assign(trips=numbers)[self.names]

    def close(self) -> None:
        pass


def _names(schema: str) -> list[str]:
    """Column names of a schema text without nested commas of its own level."""
    depth, names, start = 0, [], True
    for word in schema.replace("<", " < ").replace(">", " > ").replace(",", " , ").split():
        depth += (word == "<") - (word == ">")
        if word == "," and depth == 0:
            start = True
        elif start:
            names.append(word)
            start = False
    return names


class StatefulGate:
    """QA + drift + breaker over a stream with bounded state per feed and camera.

    ``frames_per_batch``: rows of a batch, where pieces may arrive apart (rounds are
    then numbered on from ``first_round``); None: batches arrive whole."""

    def __init__(self, cfg: GateConfig, model: drift.BaselineModel, root: str, frames_per_batch: int | None = None, first_round: int = 1):
        self.cfg, self.model, self.root = cfg, model, root.rstrip("/")
        self.frames_per_batch, self.first_round = frames_per_batch, first_round
        self.violations: list[dict] = []

    def evaluated(self, frames_stream: DataFrame) -> DataFrame:
        """One row per batch: its record, its drift report, and the camera's trips."""
        cfg, spark = self.cfg, frames_stream.sparkSession
        share_package(spark)
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
        self.violations = contract_violations(frames_stream)
        gated = qa.gate(frames_stream, cfg)
        rows = drift.point_columns(self.model, gated, "is_valid", F.coalesce("camera_id", F.lit("unknown")).alias("camera_id"),
                                   F.unix_micros(parse_utc(F.col("timestamp"))).alias("micros"))
        rows = rows.withColumns({"batch_round": F.col("batch_round").cast("bigint"),
                                 "embedding": F.when(F.col("is_valid"), F.col("embedding"))})
        batches = rows.groupBy("feed_id").transformWithStateInPandas(
            Batches(cfg.drift_window, self.frames_per_batch, self.first_round), BATCH, "Append", "None")
        batches = topology.with_known(topology.with_place(batches, cfg, "place"), "camera_id", cfg, "known")
        found = batches.groupBy("camera_id").transformWithStateInPandas(Cameras(cfg.drift_window, cfg.qa_window_batches), CAMERA, "Append", "None")
        found = drift.flagged(found.withColumns(drift.statistics_columns(self.model, cfg)).drop("win", "centre"), cfg)
        found = found.withColumns(drift.status_columns(cfg, F.col("known")))
        found = found.withColumn("drift_detected", (F.col("status") == "analyzed") & F.col("drift_detected"))
        own = ["camera_id", "feed_id", "batch_round", "place", "known", "valid_count", "quarantined_count", "micros", "rolling_q", "rolling_t", *REPORT]
        found = found.select(*own)
        types = dict(found.dtypes)
        schema = ", ".join([f"{c} {types[c]}" for c in own] + [f"last_{c} {types[c]}" for c in LAST] + ["trips bigint"])
        return found.groupBy("camera_id").transformWithStateInPandas(Latch(cfg, _names(schema)), schema, "Append", "None")

    def start(self, frames_stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        return (self.evaluated(frames_stream).writeStream.format("parquet").option("path", f"{self.root}/evaluated")
                .option("checkpointLocation", checkpoint).outputMode("append")
                .trigger(**(trigger or {"availableNow": True})).start())

    # -- output tables, projections of the one table -----------------------------
    def read(self, spark: SparkSession, table: str) -> DataFrame:
        rows = spark.read.parquet(f"{self.root}/evaluated")
        return {"qa_batches": self._batches, "drift_reports": self._reports, "breaker": self._breaker, "incidents": self._incidents,
                "retrain_requests": lambda r: incidents.retrain_requests(self._incidents(r), self.cfg),
                "pipeline_totals": lambda r: summary.pipeline_totals(self._batches(r), self._reports(r), self._incidents(r))}[table](rows)

    def totals(self, spark: SparkSession) -> DataFrame:
        """A9 over all micro-batches so far."""
        return self.read(spark, "pipeline_totals")

    def _batches(self, rows: DataFrame) -> DataFrame:
        v, q = F.col("valid_count"), F.col("quarantined_count")
        return rows.select("feed_id", "batch_round", "camera_id", "valid_count", "quarantined_count",
                           utc_text(F.timestamp_micros("micros")).alias("last_timestamp"), qa.status_expr(v, q, self.violations).alias("status"),
                           (v + q).alias("total_count"), qa.rate_expr(v, q).alias("quarantine_rate"))

    def _reports(self, rows: DataFrame) -> DataFrame:
        return drift.report_columns(rows.select("feed_id", "batch_round", "camera_id", "valid_count", *REPORT), self.cfg)

    def _breaker(self, rows: DataFrame) -> DataFrame:
        cfg = self.cfg
        last = drift.report_columns(rows.where("known").drop(*LAST).withColumnsRenamed({f"last_{c}": c for c in LAST}), cfg)
        last = last.withColumnsRenamed({"status": "drift_status", "window_size": "drift_window_size", "features": "drift_features"})
        last = last.withColumns({
            "status": qa.status_expr(F.col("valid_count"), F.col("quarantined_count"), self.violations),
            "rolling_quarantine_rate": F.when(F.col("rolling_t") == 0, F.lit(0.0)).otherwise(F.col("rolling_q").cast("double") / F.col("rolling_t"))})
        last = last.withColumn("drifted_features", breaker.drifted_features_expr(last)).withColumn("reasons", breaker.reason_structs(cfg))
        return breaker.latch_columns(last.withColumn("should_trip", F.size("reasons") > 0))

    def _incidents(self, rows: DataFrame) -> DataFrame:
        return incidents.incidents(self._breaker(rows), self._batches(rows), self._reports(rows), self.cfg)
