"""Gold aggregates per market-cap class. All of them combine before the shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.config import INCLUSIVE_CAPS, CapBuckets
from oreworks.functions import cap_category, exact_sum, ts_literal

CATEGORY = "market_cap_category"
CHANGE = "price_change_percentage_24h"
CALCULATION_TYPE = "market_category_metrics"  # fixed value


def _core() -> dict[str, Column]:
    return {
        "num_coins": F.count("*"),
        "total_market_cap": exact_sum(F.col("market_cap")),
        "total_volume_24h": exact_sum(F.col("total_volume")),
        "avg_price": F.avg("current_price"),
        "avg_price_change_24h": F.avg(CHANGE),
        "avg_volatility": F.avg("price_volatility_24h"),
        "avg_volume_ratio": F.avg("volume_to_market_cap_ratio"),
        "max_market_cap": F.max("market_cap"),
        "min_market_cap": F.min("market_cap"),
    }


def _aggregate(df: DataFrame, by: list[str], figures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[e.alias(name) for name, e in figures.items()])


def gold_by_category(silver: DataFrame, metric_ts: datetime) -> DataFrame:
    """The class-level metrics of one run."""
    stamp = ts_literal(metric_ts)
    return _aggregate(silver, [CATEGORY], _core()).withColumns(
        {
            "metric_date": stamp.cast("date"),
            "metric_timestamp": stamp,
            "calculation_type": F.lit(CALCULATION_TYPE),
        }
    )


def gold_simple(records: DataFrame, buckets: CapBuckets = INCLUSIVE_CAPS) -> DataFrame:
    """The reduced class metrics, straight from cleaned records (caps may be doubles here)."""
    classed = records.withColumn(CATEGORY, cap_category(F.col("market_cap"), buckets))
    return _aggregate(
        classed,
        [CATEGORY],
        {
            "num_coins": F.count("*"),
            "total_market_cap": F.sum("market_cap"),
            "avg_market_cap": F.avg("market_cap"),
            "total_volume": F.sum("total_volume"),
            "avg_price": F.avg("current_price"),
            "avg_price_change_24h": F.avg(CHANGE),
        },
    )


def gold_from_current(current: DataFrame, buckets: CapBuckets = INCLUSIVE_CAPS) -> DataFrame:
    """The reduced class metrics from the current Silver versions, one row per class."""
    classed = current.select(
        cap_category(F.col("market_cap"), buckets).alias(CATEGORY),
        "market_cap",
        "total_volume",
        CHANGE,
    )
    return _aggregate(
        classed,
        [CATEGORY],
        {
            "num_coins": F.count("*"),
            "total_market_cap": exact_sum(F.col("market_cap")),
            "avg_market_cap": F.avg("market_cap"),
            "total_volume": exact_sum(F.col("total_volume")),
            "avg_price_change_24h": F.avg(CHANGE),
        },
    )


def gold_extended(silver: DataFrame, metric_ts: datetime, run_id: str | None = None) -> DataFrame:
    """Every Gold column: class metrics, movers, flags, share of the market, top performers."""
    change = F.col(CHANGE)
    figures = _core() | {
        "avg_market_cap": F.avg("market_cap"),
        "total_volume": exact_sum(F.col("total_volume")),
        "avg_volume": F.avg("total_volume"),
        "num_gainers": F.count_if(change > 0),
        "num_losers": F.count_if(change <= 0),
        "num_anomalies": F.count_if("is_price_anomaly"),
        "num_volume_spikes": F.count_if("is_volume_spike"),
    }
    # The larger change wins, and of equal changes the larger id; losers likewise downwards.
    entry = F.when(change.isNotNull(), F.struct(change.alias("pct"), "coin_id", "symbol"))
    figures |= {"up": F.max(entry), "down": F.min(entry)}
    stamp = ts_literal(metric_ts)
    joined = _aggregate(silver, [CATEGORY], figures)
    # This window runs over the finished classes, not over the rows.
    whole = F.expr("CAST(sum(total_market_cap) OVER () AS DOUBLE)")
    return joined.withColumns(
        {
            "category_dominance_pct": F.try_divide(F.col("total_market_cap").cast("double"), whole)
            * 100,
            "top_gainer_symbol": F.col("up.symbol"),
            "top_gainer_change_pct": F.col("up.pct"),
            "top_loser_symbol": F.col("down.symbol"),
            "top_loser_change_pct": F.col("down.pct"),
            "metric_date": stamp.cast("date"),
            "metric_timestamp": stamp,
            "calculation_type": F.lit(CALCULATION_TYPE),
            "created_at": stamp,
            "updated_at": stamp,
            "run_id": F.lit(run_id).cast("string"),
        }
    ).drop("up", "down", "_c")
