"""Declarative row-quality rules as native Column expressions.

A :class:`Rule` is a predicate over one column.  ``evaluate_rules`` turns a
rule set into ONE projection that attaches ``failed_rules`` — an
``ARRAY<STRUCT<column, check, failure_case>>`` holding *every* failure of the
row (lazy validation), never just the first.  Nothing leaves the JVM: rules
are ``Column`` expressions and stay inside whole-stage codegen.

Null handling follows a non-nullable schema column with element checks: a
null (or NaN in a floating column) fails ``not_nullable`` and the element
check is skipped for that value.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import GateConfig

RULE_TYPE = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("failure_case", T.StringType()),
])
RULES_TYPE = T.ArrayType(RULE_TYPE)


@dataclass(frozen=True)
class Rule:
    """``passes(col)`` returns a boolean Column, true when the value is fine.

    ``failure_case(col)`` is the value reported on failure (as text).
    Null values are not passed to the check (the not-null rule reports them).
    """
    column: str
    check: str
    passes: Callable[[Column], Column]
    failure_case: Callable[[Column], Column] | None = None


def clamp(col: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """one- or two-sided clamp; null and NaN pass through unchanged."""
    out = col
    if lo is not None:
        out = F.when(out.isNull() | F.isnan(out), out).otherwise(F.greatest(out, F.lit(lo)))
    if hi is not None:
        out = F.when(out.isNull() | F.isnan(out), out).otherwise(F.least(out, F.lit(hi)))
    return out


def is_missing(col: Column, dtype: T.DataType | None) -> Column:
    """Null, or NaN for a floating column (a NaN float counts as null)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def brightness_ok(col: Column, cfg: GateConfig) -> Column:
    """inclusive range.  ``between`` is false for NaN already."""
    return col.between(F.lit(cfg.brightness_min), F.lit(cfg.brightness_max)) & ~F.isnan(col)


def blur_ok(col: Column, cfg: GateConfig) -> Column:
    """non-negative.  In Spark ``NaN >= 0`` is TRUE, hence ``~isnan``."""
    return (col >= F.lit(cfg.blur_min)) & ~F.isnan(col)


def camera_id_ok(col: Column, cfg: GateConfig) -> Column:
    """full match of the camera id pattern (``\\z`` refuses ``"x\\n"``)."""
    return col.rlike(cfg.camera_id_pattern)


def embedding_dim_ok(col: Column, cfg: GateConfig) -> Column:
    """one-dimensional with exactly ``embedding_dim`` elements."""
    return F.size(col) == F.lit(cfg.embedding_dim)


def default_rules(cfg: GateConfig) -> list[Rule]:
    """The built-in rule set, in contract column order."""
    return [
        Rule("camera_id", C.CHECK_CAMERA_ID, lambda c: camera_id_ok(c, cfg)),
        Rule("brightness_avg", C.CHECK_BRIGHTNESS, lambda c: brightness_ok(c, cfg)),
        Rule("blur_metric", C.CHECK_BLUR, lambda c: blur_ok(c, cfg)),
        Rule("embedding", C.CHECK_EMBEDDING_DIM, lambda c: embedding_dim_ok(c, cfg),
             lambda c: F.size(c).cast("string")),
    ]


def custom_rule(column: str, check: str, predicate: Column | str) -> Rule:
    """A user rule from a SQL expression (or Column) that is true when ok.

    The expression may reference any column of the row; the reported failure
    case is the value of ``column``.
    """
    expr = F.expr(predicate) if isinstance(predicate, str) else predicate
    return Rule(column, check, lambda _c: expr)


# ---------------------------------------------------------------------------
# Type coercion (F7) and the schema contract (F8)
# ---------------------------------------------------------------------------
CONTRACT_TYPES: dict[str, T.DataType] = {
    "timestamp": T.StringType(),
    "camera_id": T.StringType(),
    "frame_id": T.StringType(),
    "brightness_avg": T.DoubleType(),
    "blur_metric": T.DoubleType(),
    "embedding": T.ArrayType(T.DoubleType()),
}


def coerce_types(df: DataFrame) -> DataFrame:
    """``try_cast`` every contract column to its declared type.

    A value that is present but cannot be cast, or an array with an element
    that cannot, becomes null and records a ``coerce_dtype`` failure in
    ``_coerce_failures`` (merged by ``evaluate_rules``).  Columns already of
    the right type are untouched.
    Columns outside the contract pass through (the schema is not strict).
    """
    fails = []
    cols = {}
    present = set(df.columns)
    for name, dtype in CONTRACT_TYPES.items():
        if name not in present:
            continue
        src = df.schema[name].dataType
        if src == dtype:
            continue
        raw = F.col(name)
        cast = raw.try_cast(dtype)
        if isinstance(dtype, T.ArrayType) and isinstance(src, T.ArrayType):
            lost = F.exists(F.arrays_zip(raw.alias("raw"), cast.alias("cast")),
                            lambda e: e["raw"].isNotNull() & e["cast"].isNull())
            cast = F.when(~F.coalesce(lost, F.lit(False)), cast)
        cols[name] = cast
        check = (C.CHECK_COERCE_FLOAT if isinstance(dtype, T.DoubleType)
                 else f"coerce_dtype('{dtype.simpleString()}')")
        fails.append(F.when(raw.isNotNull() & cast.isNull(),
                            F.struct(F.lit(name).alias("column"), F.lit(check).alias("check"),
                                     raw.cast("string").alias("failure_case"))))
    arr = (F.filter(F.array(*fails), lambda x: x.isNotNull()) if fails
           else F.array().cast(RULES_TYPE))
    # failures read the raw values, so they are computed before the casts
    df = df.withColumn("_coerce_failures", arr)
    return df.withColumns(cols) if cols else df


def contract_violations(df: DataFrame) -> list[dict]:
    """F8: schema-level failures: a required column that is missing, or one whose
    type cannot be read as the declared one at all.

    Works on the schema only (no job).  Extra columns are allowed.
    """
    out = []
    for name, dtype in CONTRACT_TYPES.items():
        if name not in df.columns:
            out.append({"column": name, "check": C.CHECK_COLUMN, "failure_case": name})
        elif not _readable(df.schema[name].dataType, dtype):
            out.append({"column": name, "check": f"dtype('{dtype.simpleString()}')",
                        "failure_case": df.schema[name].dataType.simpleString()})
    return out


def _readable(src: T.DataType, dtype: T.DataType) -> bool:
    nested = (T.ArrayType, T.MapType, T.StructType)
    if isinstance(src, T.NullType):
        return True
    if isinstance(dtype, T.ArrayType):
        return isinstance(src, T.ArrayType) and not isinstance(src.elementType, (*nested, T.BinaryType, T.BooleanType))
    return not isinstance(src, (*nested, T.BinaryType)) and not (
        isinstance(dtype, T.DoubleType) and isinstance(src, (T.DateType, T.TimestampNTZType)))


def has_unreadable(violations: list[dict]) -> bool:
    """Whether a column is there but cannot be read (status ``error``)."""
    return any(v["check"] != C.CHECK_COLUMN for v in violations)


def conform(df: DataFrame) -> tuple[DataFrame, list[dict]]:
    """Missing and unreadable columns as typed nulls, and their violations.
    No row rule fires on them; the violations are alerts of the batch."""
    violations = contract_violations(df)
    return df.withColumns({v["column"]: F.lit(None).cast(CONTRACT_TYPES[v["column"]]) for v in violations}), violations


def violation_rules(violations: list[dict]) -> Column:
    """The violations as an array of rule structs."""
    return F.array(*[F.struct(*[F.lit(v[k]).alias(k) for k in ("column", "check", "failure_case")])
                     for v in violations]).cast(RULES_TYPE)


# ---------------------------------------------------------------------------
# Evaluation
# ---------------------------------------------------------------------------
def _failure_struct(column: str, check: str, case: Column) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"),
                    case.cast("string").alias("failure_case"))


def rule_failure_exprs(df: DataFrame, rules: list[Rule], skip: set[str] = frozenset()) -> list[Column]:
    """One ``when(failed, struct)`` per check, nulls for passes."""
    exprs = []
    by_col: dict[str, list[Rule]] = {}
    for r in rules:
        by_col.setdefault(r.column, []).append(r)
    ordered = [c for c in CONTRACT_TYPES] + [c for c in by_col if c not in CONTRACT_TYPES]
    for name in ordered:
        if name not in df.columns or name in skip:
            continue
        col = F.col(name)
        missing = is_missing(col, df.schema[name].dataType)
        if name in CONTRACT_TYPES:
            exprs.append(F.when(missing, _failure_struct(name, C.CHECK_NOT_NULL, F.lit(None))))
        for r in by_col.get(name, []):
            case = r.failure_case(col) if r.failure_case else col
            ok = r.passes(col)
            # a null predicate result counts as a failure unless the value is missing
            exprs.append(F.when(~missing & ~F.coalesce(ok, F.lit(False)),
                                _failure_struct(name, r.check, case)))
    return exprs


def evaluate_rules(df: DataFrame, cfg: GateConfig, rules: list[Rule] | None = None,
                   coerce: bool = True) -> DataFrame:
    """attach ``failed_rules`` and ``is_valid`` in one narrow projection.

    Columns that break the schema contract are null, and no rule looks at them."""
    rules = default_rules(cfg) if rules is None else rules
    df, violations = conform(df)
    if coerce:
        df = coerce_types(df)
    exprs = rule_failure_exprs(df, rules, skip={v["column"] for v in violations})
    found = F.filter(F.array(*exprs), lambda x: x.isNotNull()) if exprs else F.array().cast(RULES_TYPE)
    if "_coerce_failures" in df.columns:
        found = F.concat(F.col("_coerce_failures"), found)
    return (df.withColumn("failed_rules", found).drop("_coerce_failures")
              .withColumn("is_valid", F.size("failed_rules") == 0))
