"""Ranks, shares and exact percentiles over a whole table, without a single-task sort.

The shared idea: count equal values first (so a value that fills a third of the table becomes one
row), cut the distinct values into ranges, add up the counts before each range, and sort only
within a range. Results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreworks.operators.ranges import range_limits, with_range_number
from oreworks.operators.skew import attach_group_values
from oreworks.sinks.files import materialize

# The limits of the ranges travel with the plan, so their number is bounded.
MAX_RANGES = 4096


def _range_count(df: DataFrame) -> int:
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(MAX_RANGES, configured))


def value_positions(
    df: DataFrame,
    value: str,
    groups: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """One row per distinct non-null value (and group): ``n`` rows hold it, ``start`` precede it.

    ``value`` is a number, date or time.
    """
    bits = max(1, ((ranges or _range_count(df)) - 1).bit_length())
    groups = list(groups)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count("*").alias("n"))
        .filter("n > 0")
    )
    limits = counts.agg(range_limits(F.col(value), bits)).scalar()
    ranged = with_range_number(counts, F.col(value), limits, bits, "_range")
    if descending:
        ranged = ranged.withColumn("_range", -F.col("_range"))

    # One row per range (of each group) reaches this window.
    before_range = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_range")
    offsets = (
        ranged.groupBy(*groups, "_range")
        .agg(F.sum("n").alias("_range_n"))
        .withColumn("_offset", _sum_before("_range_n", before_range))
        .drop("_range_n")
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    within = Window.partitionBy(*groups, "_range").orderBy(order)
    ordered = ranged.withColumn("_before", _sum_before("n", within))
    if not groups:
        # One row per range: at most MAX_RANGES.
        placed = ordered.join(F.broadcast(offsets), "_range")
    else:
        # One range of one group is a small share of the distinct values, so this is balanced.
        named = offsets.withColumnsRenamed({g: f"_o_{g}" for g in groups} | {"_range": "_o_range"})
        match = F.col("_range") == F.col("_o_range")
        for g in groups:
            match = match & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
        placed = ordered.join(named, match)
    return placed.withColumn("start", F.col("_offset") + F.col("_before")).select(
        *groups, value, "n", "start"
    )


def _sum_before(column: str, window) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0).cast("bigint"))


def global_rank(
    df: DataFrame,
    value: str,
    output: str = "rank",
    descending: bool = True,
    ranges: int | None = None,
) -> DataFrame:
    """Rank of every row by ``value``: ties share a rank and leave a gap; null gives null.

    ``df`` is read more than once, so pass a written table, not a long derivation. The positions are
    written once; the rows meet them in a left join, whose hot values Spark splits.
    """
    positions = value_positions(df, value, descending=descending, ranges=ranges)
    positions = materialize(positions, "positions")
    ranks = positions.select(value, (F.col("start") + 1).alias(output))
    return df.join(ranks, value, "left").select(*df.columns, output)


def share_of_total(df: DataFrame, value: str, output: str) -> DataFrame:
    """``value / total * 100``; the total is a one-row subquery, rows are not moved."""
    total = df.agg(F.sum(F.col(value).cast("decimal(20,0)")).cast("double").alias("t"))
    return df.withColumn(output, F.try_divide(F.col(value), total.scalar()) * 100)


def exact_percentile(
    df: DataFrame,
    value: str,
    fraction: float,
    groups: Sequence[str],
    output: str,
    group_limit: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Interpolated percentile of every group, exact, with no group held in one task."""
    groups = list(groups)
    positions = value_positions(df, value, groups, ranges=ranges)
    sizes = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups)
        .agg((F.lit(fraction) * (F.count("*") - 1)).alias("_at"))
    )
    placed = attach_group_values(positions, sizes, groups, group_limit)
    low, high = F.floor("_at"), F.ceil("_at")
    end = F.col("start") + F.col("n")
    # At most two values of each group pass: those around the wanted position.
    around = placed.filter((F.col("start") <= high) & (end > low))
    at_low = F.max(F.when((F.col("start") <= low) & (end > low), F.col(value)))
    at_high = F.max(F.when((F.col("start") <= high) & (end > high), F.col(value)))
    weight = F.max(F.col("_at") - low)
    return around.groupBy(*groups).agg((at_low + (at_high - at_low) * weight).alias(output))
