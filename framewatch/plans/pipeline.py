"""The composed pipeline: frames -> gate -> batches -> drift -> breaker -> incidents.

``GatePipeline`` builds every named table from one frame DataFrame.  Tables are
plain DataFrames; Catalyst sees the whole plan of whatever the caller finally
materialises.  Small tables that several branches read (the batch table, window
statistics, p-values, drift reports) are written once as parquet under the
shared checkpoint folder, so they are computed once and a lost executor restarts
from the files (never a machine-local folder, never localCheckpoint).
``close`` deletes them when their last reader is done.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..config import FIXTURE_CONFIG, GateConfig
from ..functions.rules import contract_violations
from ..operators import breaker, drift, incidents, qa
from ..session import scratch_path
from ..sources.frames import frames_path, frames_table

# one fitted baseline per input version and configuration; a model is a few
# arrays bounded by the baseline's size
_MODELS: dict = {}


class GatePipeline:
    def __init__(self, spark: SparkSession, frames: DataFrame, cfg: GateConfig,
                 baseline: DataFrame | None = None, source_key: str | None = None,
                 gated: DataFrame | None = None):
        self.spark = spark
        self.frames = frames
        self.cfg = cfg
        self._baseline = baseline
        self._source_key = source_key
        self._written: list[str] = []
        self.violations = contract_violations(frames)
        if gated is not None:
            self.gated = gated

    @classmethod
    def from_sf(cls, spark: SparkSession, sf_dir: str,
                cfg: GateConfig = FIXTURE_CONFIG) -> "GatePipeline":
        return cls(spark, frames_table(spark, sf_dir), cfg, source_key=frames_path(spark, sf_dir))

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as parquet in the shared folder and read it back: for small
        tables with several readers."""
        path = scratch_path(self.spark, f"cut-{uuid.uuid4().hex}")
        df.write.parquet(path)
        self._written.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Delete the written tables; nothing built from them can be read after."""
        for path in self._written:
            hpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hpath, True)
        self._written.clear()

    # -- QA ---------------------------------------------------------------
    @cached_property
    def gated(self) -> DataFrame:
        return qa.gate(self.frames, self.cfg)

    @cached_property
    def batch_plan(self) -> DataFrame:
        """One row per (feed, round), not written: for a single reader."""
        return qa.qa_batches(self.gated, self.violations)

    @cached_property
    def batches(self) -> DataFrame:
        """One row per (feed, round), written once: the breaker, drift status,
        windows and incidents all read it."""
        return self.cut(self.batch_plan)

    @cached_property
    def valid(self) -> DataFrame:
        return qa.valid_frames(self.gated)

    @cached_property
    def quarantined(self) -> DataFrame:
        return qa.quarantined_frames(self.gated)

    # -- breaker ----------------------------------------------------------
    @cached_property
    def evaluated(self) -> DataFrame:
        return breaker.breaker_evaluation(self.batches, self.cfg, self.drift_reports)

    @cached_property
    def incidents(self) -> DataFrame:
        return incidents.incidents(self.evaluated, self.batches, self.drift_reports, self.cfg)

    # -- drift ----------------------------------------------------------------
    @cached_property
    def drift_plan(self) -> DataFrame:
        """Drift reports, not written: for a single reader."""
        return drift.drift_reports(self.valid, self.batches, self.baseline_model, self.cfg)

    @cached_property
    def drift_reports(self) -> DataFrame:
        return self.cut(self.drift_plan)

    @cached_property
    def baseline(self) -> DataFrame:
        """The given baseline, or the first rows of the configured reference period."""
        if self._baseline is not None:
            return self._baseline
        if self.cfg.baseline_rounds is None:
            raise ValueError("pass a baseline, or state the reference period in baseline_rounds")
        return drift.baseline_rows(self.valid, self.cfg, max_round=self.cfg.baseline_rounds)

    @cached_property
    def baseline_model(self):
        """Fitted once per input version and config: the model is a pure
        function of the (versioned) frames table, so it is memoised."""
        key = (self._source_key, self.cfg) if self._source_key and self._baseline is None else None
        if key is not None and key in _MODELS:
            return _MODELS[key]
        model = drift.BaselineModel.fit(self.baseline, self.cfg)
        if key is not None:
            _MODELS[key] = model
        return model
