"""Column expressions shared by the operators. All are built-in, none raises under ANSI mode."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreworks.config import CapBuckets


def ts_literal(ts: datetime) -> Column:
    """A wall-clock literal that does not depend on the session time zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_timestamp_sql(column: str) -> str:
    """SQL that parses ISO text to a UTC wall-clock time; bad text gives null.

    A trailing ``Z`` or no zone means UTC; a numeric offset is taken off, after a ``T`` or a blank,
    with or without minutes. The session time zone
    plays no part, so the same file gives the same Silver rows on every cluster.
    """
    offset = r"^(.*[T ]\d{1,2}:\d{2}.*?) ?([+-])(\d{2})(?::?(\d{2}))?$"
    wall = f"try_cast({column} AS TIMESTAMP_NTZ)"
    part = lambda i: f"regexp_extract({column}, r'{offset}', {i})"
    minutes = f"try_cast({part(3)} AS INT) * 60 + coalesce(try_cast({part(4)} AS INT), 0)"
    signed = f"if({part(2)} = '-', -1, 1) * ({minutes})"
    shifted = f"try_cast({part(1)} AS TIMESTAMP_NTZ) - make_dt_interval(0, 0, {signed})"
    return f"CASE WHEN {column} RLIKE r'{offset}' THEN {shifted} ELSE {wall} END"


def utc_timestamp(column: str) -> Column:
    return F.expr(utc_timestamp_sql(column))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null when the divisor is zero or either side is null."""
    return F.try_divide(part, whole) * 100


def exact_sum(column: Column) -> Column:
    """Sum of a long column without overflow."""
    return F.sum(column.cast("decimal(20,0)"))


def cap_category(cap: Column, buckets: CapBuckets) -> Column:
    """Size class of a market cap. A null cap falls through to the default class."""
    label = None
    if buckets.null_label is not None:
        label = F.when(cap.isNull(), buckets.null_label)
    for limit, name in buckets.thresholds:
        reached = cap >= F.lit(limit) if buckets.inclusive else cap > F.lit(limit)
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return F.lit(buckets.default) if label is None else label.otherwise(buckets.default)


def days_between(start: Column, end: Column) -> Column:
    """Number of day boundaries between two times."""
    return F.date_diff(end.cast("date"), start.cast("date"))
