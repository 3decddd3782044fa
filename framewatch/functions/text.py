"""Scalar text helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """``round(x, digits)`` of the value a double really has, ties to even.

    ``bround`` rounds the shortest decimal text.  The two differ only where
    that text ends in a 5 one place beyond: there the double may lie above or
    below the tie.  ``x * 10^(digits+1)`` is then compared with the tie as an
    exact sum of two doubles (the halves of x have few enough bits)."""
    scale = float(10 ** (digits + 1))
    nearest = F.rint(x * F.lit(scale))
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    low = x - high
    above = (high * F.lit(scale) - nearest) + low * F.lit(scale)
    tie = (F.pmod(nearest, F.lit(10.0)) == 5.0) & (F.abs(above) < 0.25)
    away = F.when(above > 0, F.floor(nearest / 10.0) + 1).when(above < 0, F.floor(nearest / 10.0))
    return F.when(tie & away.isNotNull(), away / F.lit(scale / 10.0)).otherwise(F.bround(x, digits))


def percent_text(rate: Column) -> Column:
    """``{x:.2%}``: percent with two decimals, rounded like Python."""
    return F.format_string("%.2f%%", round_half_even(rate * F.lit(100.0), 2))


def round4(x: Column) -> Column:
    """``round(x, 4)`` like Python."""
    return round_half_even(x, 4)


def frame_id(camera: Column, batch_round: Column, index: Column) -> Column:
    """``{camera}_b{round:03d}_f{index:02d}``."""
    return F.format_string("%s_b%03d_f%02d", camera, batch_round.cast("int"), index.cast("int"))


def parse_utc(text: Column) -> Column:
    """An ISO-8601 text as a timestamp; text without an offset is UTC, whatever
    the session's time zone is."""
    offset = text.rlike(r"(?:Z|[+-]\d{2}:?\d{2})\s*$")
    return F.when(offset, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp")


def _utc(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` in UTC, whatever the session's time zone is."""
    clock = F.timestamp_add("MICROSECOND", F.unix_micros(ts.cast("timestamp")),
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("string")
    return F.concat(F.substring(clock, 1, 19), F.lit("."), F.rpad(F.substring(clock, 21, 6), 6, "0"))


def utc_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds, in UTC, without an offset."""
    return F.regexp_replace(_utc(ts), " ", "T")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a UTC offset."""
    return F.concat(utc_text(ts), F.lit("+00:00"))


def compact_utc(ts: Column) -> Column:
    """Compact slug used in file names, e.g. ``20260530T140433571276Z``."""
    return F.concat(F.regexp_replace(utc_text(ts), "[-:.]", ""), F.lit("Z"))


def stable_id(*parts: Column, length: int = 12) -> Column:
    """Deterministic hex id (replaces a random UUID so replays are
    idempotent): the first ``length`` hex digits of SHA-256."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, length)
