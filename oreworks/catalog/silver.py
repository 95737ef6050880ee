"""Silver queries: cleaning, projection, derived metrics, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreworks.catalog.registry import query
from oreworks.catalog.sqltext import category_case, silver_sql, snapshot_sql
from oreworks.functions import cap_category, register_momentum
from oreworks.operators.anomalies import flag_price_anomalies, flag_volume_spikes
from oreworks.operators.silver import (
    SILVER_COLUMNS,
    SILVER_NAMES,
    basic_clean,
    cast_if_present,
    dedup_rows,
    derive_metrics,
    nan_to_null,
    project_silver,
    zero_as_null,
)
from oreworks.plans.adapters import (
    AS_OF,
    PART_CAPS,
    PART_CAPS_INCLUSIVE,
    PRICE_THRESHOLD,
    flagged_snapshot,
    market_snapshot,
    silver_snapshot,
    table,
)

_NAMES = [SILVER_NAMES.get(c, c) for c in SILVER_COLUMNS]
_DERIVED = [
    "price_volatility_24h",
    "market_cap_category",
    "volume_to_market_cap_ratio",
    "supply_percentage",
    "distance_from_ath_pct",
    "distance_from_atl_pct",
]


@query(
    "silver_project",
    silver_sql(f"SELECT {', '.join(_NAMES)} FROM silver"),
)
def _silver_project(spark, sf_dir):
    return project_silver(market_snapshot(spark, sf_dir, AS_OF, ranked=True))


@query("silver_derive", silver_sql(f"SELECT coin_id, {', '.join(_DERIVED)} FROM silver"))
def _silver_derive(spark, sf_dir):
    projected = project_silver(market_snapshot(spark, sf_dir, AS_OF))
    return derive_metrics(projected, PART_CAPS).select("coin_id", *_DERIVED)


@query(
    "cap_category",
    snapshot_sql(f"SELECT id, market_cap, {category_case()} AS market_cap_category FROM snap"),
)
def _cap_category(spark, sf_dir):
    label = cap_category(F.col("market_cap"), PART_CAPS).alias("market_cap_category")
    return market_snapshot(spark, sf_dir, AS_OF).select("id", "market_cap", label)


@query(
    "cap_category_inclusive",
    snapshot_sql(
        f"SELECT id, market_cap, {category_case(inclusive=True)} AS market_cap_category FROM snap"
    ),
)
def _cap_category_inclusive(spark, sf_dir):
    label = cap_category(F.col("market_cap"), PART_CAPS_INCLUSIVE).alias("market_cap_category")
    return market_snapshot(spark, sf_dir, AS_OF).select("id", "market_cap", label)


@query(
    "cast_if_present",
    """SELECT o_orderkey, o_totalprice AS current_price,
         TRY_CAST(o_orderpriority AS DOUBLE) AS market_cap,
         TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS market_cap_rank
       FROM orders""",
)
def _cast_if_present(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("current_price"),
        F.col("o_orderpriority").alias("market_cap"),  # text that is no number
        F.substring("o_orderpriority", 1, 1).alias("market_cap_rank"),
    )
    return cast_if_present(records)  # total_volume is absent and left out


@query(
    "basic_clean",
    """SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id, l_linenumber,
         l_discount / l_tax AS current_price
       FROM lineitem WHERE l_tax <> 0""",
)
def _basic_clean(spark, sf_dir):
    tax = F.col("l_tax")
    price = F.when(tax != 0, F.try_divide(F.col("l_discount"), tax)).otherwise(float("nan"))
    records = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("id"), "l_linenumber", price.alias("current_price")
    )
    return basic_clean(records)


@query(
    "nan_to_null",
    """SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_tax <> 0 THEN l_discount / l_tax END AS ratio
       FROM lineitem""",
)
def _nan_to_null(spark, sf_dir):
    tax = F.col("l_tax")
    ratio = F.when(tax != 0, F.try_divide(F.col("l_discount"), tax)).otherwise(float("nan"))
    lines = table(spark, sf_dir, "lineitem")
    return nan_to_null(lines.select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("ratio")))


@query(
    "zero_as_null",
    """SELECT l_orderkey, l_linenumber, l_partkey, NULLIF(l_discount, 0) AS l_discount,
         NULLIF(l_tax, 0) AS l_tax
       FROM lineitem""",
)
def _zero_as_null(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    return zero_as_null(lines, ["l_discount", "l_tax"])


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def _dedup_rows(spark, sf_dir):
    return dedup_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query(
    "momentum",
    snapshot_sql(
        """SELECT id, CASE
      WHEN price_change_percentage_24h > 5 AND price_change_pct_7d > 10
        AND price_change_pct_30d > 20 THEN 'STRONG_BULLISH'
      WHEN price_change_percentage_24h > 2 AND price_change_pct_7d > 5 THEN 'BULLISH'
      WHEN price_change_percentage_24h < -5 AND price_change_pct_7d < -10
        AND price_change_pct_30d < -20 THEN 'STRONG_BEARISH'
      WHEN price_change_percentage_24h < -2 AND price_change_pct_7d < -5 THEN 'BEARISH'
      ELSE 'NEUTRAL' END AS momentum
    FROM snap"""
    ),
)
def _momentum(spark, sf_dir):
    register_momentum(spark)
    return market_snapshot(spark, sf_dir, AS_OF).selectExpr(
        "id",
        """calculate_momentum(price_change_percentage_24h,
           price_change_percentage_7d_in_currency,
           price_change_percentage_30d_in_currency) AS momentum""",
    )


@query(
    "price_anomaly",
    silver_sql("SELECT coin_id, price_change_percentage_24h, is_price_anomaly FROM flagged"),
)
def _price_anomaly(spark, sf_dir):
    silver = silver_snapshot(spark, sf_dir)
    return flag_price_anomalies(silver, PRICE_THRESHOLD).select(
        "coin_id", "price_change_percentage_24h", "is_price_anomaly"
    )


@query(
    "volume_spike",
    silver_sql("SELECT coin_id, market_cap_category, total_volume, is_volume_spike FROM flagged"),
)
def _volume_spike(spark, sf_dir):
    needed = ("coin_id", "market_cap_category", "total_volume", "price_change_percentage_24h")
    return flagged_snapshot(spark, sf_dir, columns=needed).select(
        "coin_id", "market_cap_category", "total_volume", "is_volume_spike"
    )


@query(
    "event_spikes",
    """WITH stats AS (
         SELECT user_id, avg(value) + 3 * stddev_samp(value) AS spike_above
         FROM events GROUP BY user_id)
       SELECT e.user_id, CAST(count(*) AS BIGINT) AS num_events,
         CAST(count(*) FILTER (value > spike_above) AS BIGINT) AS num_spikes
       FROM events e JOIN stats s ON e.user_id = s.user_id GROUP BY e.user_id""",
)
def _event_spikes(spark, sf_dir):
    """Spikes where the number of groups has no limit: heavy groups are settled by broadcast."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    flagged = flag_volume_spikes(events, group="user_id", value="value")
    return flagged.groupBy("user_id").agg(
        F.count("*").alias("num_events"), F.count_if("is_volume_spike").alias("num_spikes")
    )
