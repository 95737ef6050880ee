"""Price and volume anomaly flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.config import SPIKE_STDDEVS
from oreworks.operators.skew import attach_group_values
from oreworks.sinks.files import materialize


def price_anomaly(change_pct: Column, threshold: float) -> Column:
    """The change is larger than ``threshold`` (a fraction); an unknown change is no anomaly."""
    return F.coalesce(F.abs(change_pct) > F.lit(threshold * 100), F.lit(False))


def flag_price_anomalies(
    df: DataFrame, threshold: float, change: str = "price_change_percentage_24h"
) -> DataFrame:
    return df.withColumn("is_price_anomaly", price_anomaly(F.col(change), threshold))


def flag_volume_spikes(
    df: DataFrame,
    group: str | Sequence[str] = "market_cap_category",
    value: str = "total_volume",
    width: float = SPIKE_STDDEVS,
    group_limit: int | None = None,
) -> DataFrame:
    """Flag rows above mean + ``width`` sample deviations of their group.

    The group figures come from a partial aggregate and are joined back; a window would move every
    row of a group into one task. ``df`` is read again for the join, so pass a written table.
    Without a limit of the number of groups, their figures are written before they are joined.
    """
    group = [group] if isinstance(group, str) else list(group)
    stats = df.groupBy(*group).agg(
        (F.avg(value) + F.lit(width) * F.stddev_samp(value)).alias("_spike_above")
    )
    if group_limit is None:
        stats = materialize(stats, "group-stats")
    return (
        attach_group_values(df, stats, group, group_limit)
        .withColumn(
            "is_volume_spike", F.coalesce(F.col(value) > F.col("_spike_above"), F.lit(False))
        )
        .drop("_spike_above")
    )


def detect_anomalies(
    df: DataFrame,
    price_threshold: float,
    group_limit: int | None = None,
    group: str | Sequence[str] = "market_cap_category",
) -> DataFrame:
    """Both flags."""
    flagged = flag_price_anomalies(df, price_threshold)
    return flag_volume_spikes(flagged, group, group_limit=group_limit)


def anomalous_rows(df: DataFrame) -> DataFrame:
    return df.filter("is_price_anomaly OR is_volume_spike")
