"""The topology: which cameras are known, and the order of their feeds.

A configuration names a few cameras itself (``known_cameras``) or the folder of a
table of them (``topology``): ``camera_id`` and ``place``, the place of its feed in the
order.  Retired cameras have a negative place.  With a table no plan and no row
grows with the number of cameras: membership is a semi or anti join, the order comes from a
join, and where the left side is stored by feed the cameras prune its folders at run time.

Defined cases: a null id is not known; of rows that repeat a camera the least place in
use counts; feeds without a place come last, by their id; with an empty table nothing is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GateConfig

TOPOLOGY_SCHEMA = "camera_id string, place int"
LAST = (1 << 31) - 1
PLACE, KNOWN = "_place", "_known"


def write_topology(cameras: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by ``cameras`` (camera_id, place)."""
    cameras.select("camera_id", F.col("place").cast("int").alias("place")).write.mode("overwrite").parquet(path)


def cameras_in_use(spark: SparkSession, cfg: GateConfig) -> DataFrame:
    """``_camera`` and ``_place`` of the table, one row per camera in use."""
    rows = spark.read.schema(TOPOLOGY_SCHEMA).parquet(cfg.topology).where((F.col("place") >= 0) & F.col("camera_id").isNotNull())
    return rows.groupBy(F.col("camera_id").alias("_camera")).agg(F.min("place").alias(PLACE))


def _listed(column: str, cfg: GateConfig) -> Column:
    return F.coalesce(F.col(column).isin(list(cfg.known_cameras)), F.lit(False))


def known_rows(df: DataFrame, column: str, cfg: GateConfig) -> DataFrame:
    """Rows whose ``column`` is a known camera."""
    if cfg.topology is None:
        return df.where(_listed(column, cfg))
    return df.join(cameras_in_use(df.sparkSession, cfg), F.col(column) == F.col("_camera"), "left_semi")


def unknown_rows(df: DataFrame, column: str, cfg: GateConfig) -> DataFrame:
    """The other side of :func:`known_rows`, null ids included."""
    if cfg.topology is None:
        return df.where(~_listed(column, cfg))
    return df.join(cameras_in_use(df.sparkSession, cfg), F.col(column) == F.col("_camera"), "left_anti")


def with_known(df: DataFrame, column: str, cfg: GateConfig, name: str = KNOWN) -> DataFrame:
    """``df`` with a boolean ``name``: whether ``column`` is a known camera."""
    if cfg.topology is None:
        return df.withColumn(name, _listed(column, cfg))
    cameras = cameras_in_use(df.sparkSession, cfg).select("_camera")
    return df.join(cameras, F.col(column) == F.col("_camera"), "left").withColumn(name, F.col("_camera").isNotNull()).drop("_camera")


def with_place(df: DataFrame, cfg: GateConfig, name: str = PLACE) -> DataFrame:
    """``df`` with ``name``: the place of its ``feed_id`` in the order."""
    if cfg.topology is None:
        place = F.array_position(F.array(*[F.lit(c) for c in cfg.known_cameras]), F.col("feed_id")).cast("int")
        return df.withColumn(name, F.when(place > 0, place).otherwise(LAST))
    cameras = cameras_in_use(df.sparkSession, cfg).withColumnRenamed(PLACE, "_found")
    return df.join(cameras, F.col("feed_id") == F.col("_camera"), "left").withColumn(
        name, F.coalesce("_found", F.lit(LAST))).drop("_camera", "_found")


def stream_order() -> list[Column]:
    """Order of the batches of one camera, of rows :func:`with_place`: round, then the feeds' order."""
    return [F.col("batch_round"), F.col(PLACE), F.col("feed_id")]
