"""Gold and daily-summary tables: keyed upsert and refresh of one day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.functions import ts_literal
from oreworks.operators.history import latest_per_key
from oreworks.operators.merge import upsert
from oreworks.operators.sketches import merge_sketches, quantile_sketches, sketch_quantiles
from oreworks.plans.views import daily_market_summary
from oreworks.schemas import GOLD_CONTRACT, GOLD_UPDATED
from oreworks.sinks.files import child_names, materialize
from oreworks.sinks.tables import drop_partition, replace_partitions, write_table

SUMMARY_DAY = "summary_date"


def _has_rows(spark: SparkSession, path: str, partition: str) -> bool:
    return any(n.startswith(f"{partition}=") for n in child_names(spark, path))


def append_gold(gold: DataFrame, path: str) -> None:
    write_table(gold, path, "append", GOLD_CONTRACT.partition_by, GOLD_CONTRACT.cluster_by)


def upsert_gold(
    gold: DataFrame,
    path: str,
    key: Sequence[str] = GOLD_CONTRACT.key,
    updated: Sequence[str] | None = GOLD_UPDATED,
    partition_by: str = "metric_date",
    newest: Sequence[str] = ("metric_timestamp",),
) -> int:
    """Update rows with the same key, insert the others; only touched dates are rewritten."""
    spark = gold.sparkSession
    batch = materialize(latest_per_key(gold, key, newest), "gold-batch")
    if not _has_rows(spark, path, partition_by):
        return replace_partitions(batch, path, partition_by)
    touched = _touched(spark.read.parquet(path), batch, partition_by)
    return replace_partitions(upsert(touched, batch, key, updated), path, partition_by)


def _touched(table: DataFrame, batch: DataFrame, partition_by: str) -> DataFrame:
    """Rows of the partitions that occur in the batch, a written table; Spark prunes the others."""
    return table.join(batch.select(partition_by).distinct(), partition_by, "left_semi")


def write_daily_summary(versions: DataFrame, path: str, created_at: datetime) -> int:
    summary = daily_market_summary(versions).withColumn("created_at", ts_literal(created_at))
    write_table(summary, path, "overwrite", [SUMMARY_DAY])
    return versions.sparkSession.read.parquet(path).count()


def store_sketches(df: DataFrame, path: str, value: str, period: str, groups: Sequence[str]) -> int:
    """Keep the quantile sketches of ``value`` per period and group.

    The periods that occur in ``df`` are replaced, so a repeated load counts once. Pass whole periods.
    """
    return replace_partitions(quantile_sketches(df, value, [period, *groups]), path, period)


def stored_quantiles(
    spark: SparkSession,
    path: str,
    fractions: Sequence[float],
    groups: Sequence[str],
    periods: Column | None = None,
) -> DataFrame:
    """Quantiles over all stored periods, or over those that ``periods`` chooses by partition."""
    stored = spark.read.parquet(path)
    chosen = stored if periods is None else stored.filter(periods)
    return sketch_quantiles(merge_sketches(chosen, groups), fractions)


def refresh_daily_summary(
    versions: DataFrame, path: str, day: date, created_at: datetime
) -> int:
    """Recompute one day and replace it; a day without rows disappears."""
    summary = daily_market_summary(versions, day).withColumn("created_at", ts_literal(created_at))
    rows = replace_partitions(summary, path, SUMMARY_DAY)
    if rows == 0:
        drop_partition(versions.sparkSession, path, SUMMARY_DAY, day.isoformat())
    return rows
