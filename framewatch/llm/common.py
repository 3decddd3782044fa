"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.frames import table_path

#: Separators of words: the ASCII white space \x20 and \x09-\x0D, nothing else.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def use_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.  On a
    cluster it is installed on the executors, and the added path does no harm."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_package(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Later jobs restart from these files when an executor is lost, and nothing
    above them is computed twice.  Every call takes a folder of its own.
    """
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable
    is never inlined, so it may be used inside further lambdas at no cost."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null text: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), lambda w: w != "")


def unit(*cols: Column) -> Column:
    """A uniform draw in [0, 1) that depends on the given values only."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))
