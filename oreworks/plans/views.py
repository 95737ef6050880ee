"""The analytical views, as functions from a table to a DataFrame.

Silver views take all versions or the current ones; where a total order is asked for, the key
settles ties, which also lets the sort split a value that occurs in many rows.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.functions import days_between, exact_sum, percent_of, ts_literal
from oreworks.operators.anomalies import anomalous_rows
from oreworks.operators.ranking import exact_percentile, global_rank, share_of_total
from oreworks.operators.sketches import quantile_sketches, sketch_quantiles
from oreworks.sinks.bronze_store import extraction_stats

CHANGE = "price_change_percentage_24h"
CATEGORY = "market_cap_category"

MARKET_STATE_COLUMNS = (
    "coin_id",
    "symbol",
    "name",
    "current_price",
    "market_cap",
    "market_cap_rank",
    "market_cap_category",
    "total_volume",
    "price_change_percentage_24h",
    "price_volatility_24h",
    "volume_to_market_cap_ratio",
    "distance_from_ath_pct",
    "is_price_anomaly",
    "is_volume_spike",
    "updated_at",
)


def only_current(versions: DataFrame) -> DataFrame:
    return versions.filter("is_current")


def current_market_state(versions: DataFrame) -> DataFrame:
    state = only_current(versions).select(*MARKET_STATE_COLUMNS)
    return state.orderBy("market_cap_rank", "coin_id")


def top_by_market_cap(versions: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` of the market state with their metrics."""
    return (
        current_market_state(versions)
        .select(
            "coin_id",
            "symbol",
            "name",
            "current_price",
            "market_cap",
            "market_cap_rank",
            CHANGE,
            "volume_to_market_cap_ratio",
            "distance_from_ath_pct",
        )
        .limit(n)
    )


def anomalies_detected(versions: DataFrame) -> DataFrame:
    """Flagged current rows, the largest change first."""
    return (
        anomalous_rows(only_current(versions))
        .select(
            "coin_id",
            "symbol",
            "name",
            "current_price",
            CHANGE,
            "is_price_anomaly",
            "is_volume_spike",
            "updated_at",
        )
        .orderBy(F.abs(CHANGE).desc_nulls_last(), "coin_id")
    )


def price_history(versions: DataFrame, as_of: datetime) -> DataFrame:
    """Every version with the days its price held, open ones counted up to ``as_of``."""
    end = F.coalesce(F.col("valid_to"), ts_literal(as_of))
    return versions.select(
        "coin_id",
        "symbol",
        "name",
        "current_price",
        "market_cap",
        "valid_from",
        "valid_to",
        days_between(F.col("valid_from"), end).alias("days_at_price"),
    ).orderBy("coin_id", F.desc("valid_from"))


def top_movers(versions: DataFrame, n: int = 20) -> DataFrame:
    """The largest changes in either direction; no change counts as LOSER."""
    change = F.col(CHANGE)
    return (
        only_current(versions)
        .filter(change.isNotNull())
        .select(
            "coin_id",
            "symbol",
            "name",
            "current_price",
            CHANGE,
            "market_cap",
            "total_volume",
            F.when(change > 0, "GAINER").otherwise("LOSER").alias("movement_type"),
        )
        .orderBy(F.abs(change).desc(), "coin_id")
        .limit(n)
    )


def market_dominance(versions: DataFrame) -> DataFrame:
    """Share of the whole market and rank by market cap. Reads its input more than once."""
    held = only_current(versions).filter(F.col("market_cap").isNotNull())
    held = held.select("coin_id", "symbol", "name", "market_cap")
    shared = share_of_total(held, "market_cap", "market_dominance_pct")
    ranked = global_rank(shared, "market_cap", output="dominance_rank")
    return ranked.orderBy(F.desc("market_cap"), "coin_id")


def volatility_analysis(versions: DataFrame, group_limit: int | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact median of volatility per class."""
    v = "price_volatility_24h"
    held = only_current(versions).filter(F.col(v).isNotNull()).select(CATEGORY, v)
    stats = held.groupBy(CATEGORY).agg(
        F.count("*").alias("num_coins"),
        F.avg(v).alias("avg_volatility"),
        F.stddev_samp(v).alias("stddev_volatility"),
        F.min(v).alias("min_volatility"),
        F.max(v).alias("max_volatility"),
    )
    median = exact_percentile(held, v, 0.5, [CATEGORY], "median_volatility", group_limit)
    renamed = median.withColumnRenamed(CATEGORY, "_c")
    return stats.join(renamed, F.col(CATEGORY).eqNullSafe(F.col("_c")), "left").drop("_c")


def volatility_estimate(versions: DataFrame) -> DataFrame:
    """Approximate medians per class in one pass, for dashboards that can live with a rank error."""
    sketches = quantile_sketches(only_current(versions), "price_volatility_24h", [CATEGORY])
    median = F.col("value").alias("median_volatility")
    return sketch_quantiles(sketches, [0.5]).select(
        CATEGORY, F.col("num_rows").alias("num_coins"), median
    )


def daily_market_summary(versions: DataFrame, day: date | None = None) -> DataFrame:
    """Class figures per day of last update, for all days or for one."""
    held = only_current(versions)
    if day is not None:
        # Limits on the column itself reach the file scan; a test of its date would not.
        start = datetime.combine(day, datetime.min.time())
        updated = F.col("updated_at")
        held = held.filter(
            (updated >= ts_literal(start)) & (updated < ts_literal(start + timedelta(days=1)))
        )
    held = held.withColumn("summary_date", F.to_date("updated_at"))
    return held.groupBy("summary_date", CATEGORY).agg(
        F.count("*").alias("num_coins"),
        exact_sum(F.col("market_cap")).alias("total_market_cap"),
        exact_sum(F.col("total_volume")).alias("total_volume"),
        F.avg("current_price").alias("avg_price"),
        F.avg(CHANGE).alias("avg_price_change_24h"),
        F.avg("price_volatility_24h").alias("avg_volatility"),
        F.count_if("is_price_anomaly").alias("num_anomalies"),
        F.count_if("is_volume_spike").alias("num_volume_spikes"),
    )


def data_quality_metrics(versions: DataFrame, checked_at: datetime) -> DataFrame:
    """Counts of doubtful current rows per day of last update, as seen at ``checked_at``."""
    price = F.col("current_price")
    nulls = F.count_if(price.isNull())
    return (
        only_current(versions)
        .groupBy(F.to_date("updated_at").alias("check_date"))
        .agg(
            F.count("*").alias("total_records"),
            nulls.alias("null_price_count"),
            F.count_if(F.col("market_cap").isNull()).alias("null_market_cap_count"),
            F.count_if(price < 0).alias("negative_price_count"),
            F.count_if("is_price_anomaly").alias("anomaly_count"),
            ((1 - nulls / F.count("*")) * 100).alias("price_completeness_pct"),
        )
        .withColumn("checked_at", ts_literal(checked_at))
    )


def run_history(runs: DataFrame) -> DataFrame:
    """Runs, newest first, with minutes taken and share of records processed."""
    extracted = F.col("records_extracted")
    rate = F.round(percent_of(F.col("records_processed").cast("double"), extracted), 2)
    return runs.select(
        "run_id",
        "pipeline_name",
        "run_date",
        "status",
        "records_extracted",
        "records_processed",
        "records_loaded",
        "records_failed",
        F.round(F.col("execution_time_seconds") / 60, 2).alias("execution_time_minutes"),
        F.when(extracted > 0, rate).otherwise(F.lit(0.0)).alias("success_rate_pct"),
        "error_message",
        "created_at",
    ).orderBy(F.desc("run_date"), "run_id")


def run_health(runs: DataFrame, n: int = 10) -> DataFrame:
    return run_history(runs).limit(n)


def market_summary(gold: DataFrame) -> DataFrame:
    return gold.select(
        "metric_date",
        CATEGORY,
        "num_coins",
        "total_market_cap",
        "avg_market_cap",
        "total_volume",
        "avg_price_change_24h",
        "num_gainers",
        "num_losers",
        "category_dominance_pct",
    ).orderBy(F.desc("metric_date"), F.desc("total_market_cap"), CATEGORY)


def category_comparison(gold: DataFrame, day: date) -> DataFrame:
    """The classes of one day side by side; only that day's partition is read."""
    return (
        gold.filter(F.col("metric_date") == F.lit(day))
        .select(
            CATEGORY, "num_coins", "total_market_cap", "avg_price_change_24h", "avg_volatility"
        )
        .orderBy(F.desc("total_market_cap"), CATEGORY)
    )


def register_views(
    versions: DataFrame,
    gold: DataFrame,
    runs: DataFrame,
    as_of: datetime,
    bronze: DataFrame | None = None,
) -> None:
    """Make all views available to SQL users of the session."""
    views = {
        "v_current_market_state": current_market_state(versions),
        "v_price_history": price_history(versions, as_of),
        "v_top_movers_24h": top_movers(versions),
        "v_market_dominance": market_dominance(versions),
        "v_volatility_analysis": volatility_analysis(versions),
        "daily_market_summary": daily_market_summary(versions),
        "v_data_quality_metrics": data_quality_metrics(versions, as_of),
        "v_pipeline_execution_history": run_history(runs),
        "v_market_summary": market_summary(gold),
    }
    if bronze is not None:
        views["v_bronze_extraction_stats"] = extraction_stats(bronze)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
