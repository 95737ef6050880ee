"""Frame-level quality checks.

Every check returns rows of the same shape
``(check, column_name, metric, value, threshold, passed)`` so that reports can be filtered, stored
and compared. All row-wise rules of a report share one aggregate pass; no rows are collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oreworks.config import Z_THRESHOLD, FrameRules
from oreworks.functions import ts_literal
from oreworks.operators.validation import out_of_range
from oreworks.schemas import TableContract

REPORT_FIELDS = ("check", "column_name", "metric", "value", "threshold", "passed")
COLUMNS_A_SCAN = 60


def _line(check: str, column: str, metric: str, value, threshold, passed) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column_name"),
        F.lit(metric).alias("metric"),
        as_column(value).cast("double").alias("value"),
        as_column(threshold).cast("double").alias("threshold"),
        as_column(passed).cast("boolean").alias("passed"),
    )


def _report(stats: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return stats.select(F.inline(F.array(*lines)))


def _null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def quality_report(df: DataFrame, rules: FrameRules, as_of: datetime | None = None) -> DataFrame:
    """Completeness, range and freshness in one pass; uniqueness takes a second one for all its columns."""
    stats: dict[str, Column] = {"total": F.count("*")}
    lines: list[Column] = []
    for c in [c for c in rules.required if c in df.columns]:
        stats[f"nulls_{c}"] = _null_count(c)
        share = F.coalesce(F.try_divide(F.col(f"nulls_{c}"), F.col("total")) * 100, F.lit(0.0))
        ok = share < rules.max_null_pct
        lines.append(_line("completeness", c, "null_count", F.col(f"nulls_{c}"), None, ok))
        lines.append(_line("completeness", c, "null_percentage", share, rules.max_null_pct, ok))
    for c, (low, high) in rules.ranges.items():
        if c in df.columns:
            stats[f"outside_{c}"] = F.count_if(out_of_range(F.col(c), low, high))
            outside = F.col(f"outside_{c}")
            lines.append(_line("range", c, "out_of_range_count", outside, 0, outside == 0))
    fresh = rules.freshness if rules.freshness in df.columns else None
    if fresh:
        if as_of is None:
            raise ValueError("a freshness rule needs as_of")
        stats["latest"] = F.max(fresh)
        micros = F.timestamp_diff("MICROSECOND", F.col("latest"), ts_literal(as_of))
        age = micros / F.lit(3_600_000_000.0)
        limit = rules.max_age_hours
        line = _line("freshness", fresh, "age_hours", age, limit, age <= limit)
        lines.append(F.when(F.col("latest").isNotNull(), line))
    parts = []
    if lines:
        totals = df.agg(*[expr.alias(name) for name, expr in stats.items()])
        parts.append(_report(totals, lines).filter("check IS NOT NULL"))
    unique = [c for c in rules.unique if c in df.columns]
    if unique:
        parts.append(uniqueness_report(df, unique))
    if not parts:
        raise ValueError("no rule applies to the columns of this frame")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def uniqueness_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total, distinct and duplicate values per column; null counts as one value.

    All columns are counted in one scan and one shuffle: each column is a grouping set of its own,
    so values are compared in their own types. The counts combine before the shuffle, so a value
    that fills much of the table is one row per task by then. A grouping id has 64 bits; more
    columns than :data:`COLUMNS_A_SCAN` take a further scan.
    """
    distinct = list(dict.fromkeys(columns))
    parts = [
        _uniqueness_of(df, distinct[at : at + COLUMNS_A_SCAN])
        for at in range(0, len(distinct), COLUMNS_A_SCAN)
    ]
    return reduce(DataFrame.unionByName, parts)


def _uniqueness_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The report of some columns. ``_which`` has a zero bit for the column that a row counts."""
    keys = [f"_v{place}" for place in range(len(columns))]
    values = df.select(*[_groupable(df, c).alias(k) for c, k in zip(columns, keys, strict=True)])
    counted = values.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("_which"), F.count("*").alias("n")
    )
    every = (1 << len(keys)) - 1
    stats, lines = [], []
    for place, c in enumerate(columns):
        here = F.col("_which") == (every ^ (1 << (len(keys) - 1 - place)))
        total, distinct = f"_total{place}", f"_distinct{place}"
        stats.append(F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0)).alias(total))
        stats.append(F.count_if(here).alias(distinct))
        extra = F.col(total) - F.col(distinct)
        ok = extra == 0
        lines += [
            _line("uniqueness", c, "total", F.col(total), None, ok),
            _line("uniqueness", c, "distinct", F.col(distinct), None, ok),
            _line("uniqueness", c, "duplicates", extra, 0, ok),
        ]
    return _report(counted.agg(*stats), lines)


def _groupable(df: DataFrame, column: str) -> Column:
    """Maps cannot be grouped; their entries can."""
    is_map = isinstance(df.schema[column].dataType, T.MapType)
    return F.map_entries(column) if is_map else F.col(column)


def fold_report(report: DataFrame) -> dict:
    """A report as nested dicts. The report has a handful of rows per checked column."""
    folded: dict = {"passed": True, "checks": {}}
    for row in report.toLocalIterator():
        entry = folded["checks"].setdefault(f"{row.column_name}_{row.check}", {})
        entry[row.metric] = row.value
        entry["passed"] = row.passed
        folded["passed"] = folded["passed"] and row.passed is not False
    return folded


def validate_frame(
    df: DataFrame,
    required: Sequence[str],
    non_null: Sequence[str] = (),
    raise_on_error: bool = False,
) -> DataFrame:
    """Missing columns are errors, nulls are warnings; row and column counts are included."""
    missing = [c for c in dict.fromkeys(required) if c not in df.columns]
    if missing and raise_on_error:
        raise ValueError(f"missing required columns: {missing}")
    present = [c for c in dict.fromkeys(non_null) if c in df.columns]
    totals = df.agg(
        F.count("*").alias("rows"), *[_null_count(c).alias(f"nulls_{c}") for c in present]
    )
    lines = [
        _line("stats", "*", "total_rows", F.col("rows"), None, True),
        _line("stats", "*", "total_columns", len(df.columns), None, True),
    ]
    lines += [_line("required", c, "missing_column", 1, 0, False) for c in missing]
    for c in present:
        nulls = F.col(f"nulls_{c}")
        # A warning does not fail the frame.
        lines.append(F.when(nulls > 0, _line("warning", c, "null_count", nulls, 0, True)))
    return _report(totals, lines).filter("check IS NOT NULL")


def validate_schema(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """One row per mismatch: ``(column_name, issue, expected, actual, rows, castable_rows)``.

    ``expected`` takes type names in any usual form (``LongType``, ``LongType()``, ``bigint``).
    The row counts say how many rows hold a value and how many of those the expected type could
    take, which is what a migration needs to know.
    """
    fields = {f.name: f.dataType for f in df.schema}
    stats = [F.count("*").alias("_rows")]
    lines = []
    for c, wanted in expected.items():
        target = _type_of(wanted)
        entry = {"column_name": F.lit(c), "expected": F.lit(wanted)}
        if c not in fields:
            entry |= {"issue": F.lit("missing"), "actual": F.lit(None).cast("string")}
            entry |= {"rows": F.col("_rows"), "castable_rows": F.lit(0).cast("bigint")}
        elif fields[c] != target:
            stats.append(F.count(c).alias(f"_n_{c}"))
            stats.append(F.count(_try_as(F.col(c), fields[c], target)).alias(f"_ok_{c}"))
            entry |= {"issue": F.lit("type_mismatch")}
            entry |= {"actual": F.lit(type(fields[c]).__name__)}
            entry |= {"rows": F.col(f"_n_{c}"), "castable_rows": F.col(f"_ok_{c}")}
        else:
            continue
        lines.append(F.struct(*[entry[k].alias(k) for k in _SCHEMA_REPORT]))
    totals = df.agg(*stats)
    if not lines:
        empty = ", ".join(f"CAST(NULL AS STRING) {k}" for k in _SCHEMA_REPORT[:4])
        zeros = ", ".join(f"CAST(0 AS BIGINT) {k}" for k in _SCHEMA_REPORT[4:])
        return df.sparkSession.sql(f"SELECT {empty}, {zeros} WHERE false")
    return _report(totals, lines)


_SCHEMA_REPORT = ("column_name", "issue", "expected", "actual", "rows", "castable_rows")


def _type_of(name: str) -> T.DataType:
    text = name.strip()
    class_name = text.removesuffix("()")
    if class_name.endswith("Type") and hasattr(T, class_name):
        return getattr(T, class_name)()
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


def _try_as(column: Column, actual: T.DataType, target: T.DataType) -> Column:
    if isinstance(actual, T.NumericType) and isinstance(target, (T.TimestampNTZType, T.DateType)):
        return F.lit(None)  # no such conversion
    return column.try_cast(target)


def _numeric_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    fields = {f.name: f.dataType for f in df.schema}
    numeric = (T.NumericType, T.BooleanType)
    return [c for c in columns if c in fields and isinstance(fields[c], numeric)]


def _without_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN is no value: it takes no part in the moments and is no outlier."""
    floats = [c for c in columns if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def _moments(df: DataFrame, columns: Sequence[str]) -> Column:
    """Mean and sample deviation of every column, as one struct from one aggregate pass."""
    stats = [F.count("*").alias("total")]
    for c in columns:
        stats.append(F.avg(F.col(c).cast("double")).alias(f"mean_{c}"))
        stats.append(F.stddev_samp(F.col(c).cast("double")).alias(f"std_{c}"))
    return df.agg(*stats).select(F.struct("*").alias("s")).scalar()


def _is_outlier(column: str, moments: Column, z_threshold: float) -> Column:
    std = moments[f"std_{column}"]
    z = F.try_divide(F.col(column).cast("double") - moments[f"mean_{column}"], std)
    return F.coalesce((std > 0) & (F.abs(z) > z_threshold), F.lit(False))


def zscore_report(
    df: DataFrame, columns: Sequence[str], z_threshold: float = Z_THRESHOLD
) -> DataFrame:
    """Outliers per numeric column by z-score; constant and non-numeric columns are left out."""
    columns = _numeric_columns(df, columns)
    df = _without_nan(df, columns)
    moments = _moments(df, columns)
    counts = df.agg(
        *[F.count_if(_is_outlier(c, moments, z_threshold)).alias(f"n_{c}") for c in columns]
    ).withColumn("s", moments)
    lines = []
    for c in columns:
        n, std = F.col(f"n_{c}"), F.col("s")[f"std_{c}"]
        share = F.try_divide(n, F.col("s")["total"]) * 100
        for metric, value, limit in (
            ("anomaly_count", n, 0),
            ("anomaly_percentage", share, None),
            ("mean", F.col("s")[f"mean_{c}"], None),
            ("std", std, None),
            ("z_threshold", F.lit(z_threshold), None),
        ):
            lines.append(F.when(std > 0, _line("zscore", c, metric, value, limit, n == 0)))
    return _report(counts, lines).filter("check IS NOT NULL")


def zscore_examples(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    z_threshold: float = Z_THRESHOLD,
    first: int = 10,
) -> DataFrame:
    """The first outlying values of each numeric column, in the order of ``order_by``.

    Each task keeps at most ``first`` rows per column before the shuffle.
    """
    columns = _numeric_columns(df, columns)
    df = _without_nan(df, columns)
    moments = _moments(df, columns)
    outlier = {c: _is_outlier(c, moments, z_threshold) for c in columns}
    any_outlier = F.lit(False)
    for test in outlier.values():
        any_outlier = any_outlier | test
    picked = F.array(
        *[
            F.when(
                test,
                F.struct(
                    F.lit(c).alias("column_name"), F.col(c).cast("double").alias("anomaly_value")
                ),
            )
            for c, test in outlier.items()
        ]
    )
    order = Window.partitionBy("column_name").orderBy(*order_by, "anomaly_value")
    return (
        df.filter(any_outlier)
        .select(*order_by, F.inline(picked))
        .filter("column_name IS NOT NULL")
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= first)
    )


def contract_nulls(df: DataFrame, contract: TableContract) -> DataFrame:
    """Null count of every column the contract wants filled."""
    columns = [c for c in contract.not_null if c in df.columns]
    totals = df.agg(*[_null_count(c).alias(c) for c in columns])
    return _report(
        totals,
        [_line("not_null", c, "null_count", F.col(c), 0, F.col(c) == 0) for c in columns],
    )


def contract_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).filter("row_count > 1")
