"""Gold queries and the views over the current state."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreworks.catalog.registry import as_long, query, rounded
from oreworks.catalog.sqltext import category_case, silver_sql, snapshot_sql
from oreworks.operators.gold import (
    gold_by_category,
    gold_extended,
    gold_from_current,
    gold_simple,
)
from oreworks.operators.ranking import global_rank
from oreworks.operators.silver import basic_clean, cast_if_present
from oreworks.operators.sketches import rank_errors
from oreworks.plans import views
from oreworks.plans.adapters import (
    AS_OF,
    PART_CAPS,
    PART_CAPS_INCLUSIVE,
    flagged_snapshot,
    market_snapshot,
    silver_snapshot,
    table,
)
from oreworks.plans.gold_store import store_sketches, stored_quantiles
from oreworks.sinks.files import materialize, shared_dir
from oreworks.sources.landing import register

_CHANGE = "price_change_percentage_24h"
_CORE_SQL = """
  CAST(count(*) AS BIGINT) AS num_coins,
  CAST(sum(market_cap) AS BIGINT) AS total_market_cap,
  CAST(sum(total_volume) AS BIGINT) AS total_volume_24h,
  round(avg(current_price), 6) AS avg_price,
  round(avg(price_change_percentage_24h), 6) AS avg_price_change_24h,
  round(avg(price_volatility_24h), 6) AS avg_volatility,
  round(avg(volume_to_market_cap_ratio), 12) AS avg_volume_ratio,
  max(market_cap) AS max_market_cap,
  min(market_cap) AS min_market_cap"""
_CORE_AVERAGES = ("avg_price", "avg_price_change_24h", "avg_volatility")


def _current(spark, sf_dir, *columns, ranked=False):
    """The flagged snapshot as current versions, narrowed to what a view uses."""
    base = ("coin_id", "market_cap_category", "total_volume", _CHANGE)
    wanted = tuple(dict.fromkeys(base + columns))
    return flagged_snapshot(spark, sf_dir, columns=wanted, ranked=ranked)


def _silver(spark, sf_dir, *columns):
    """The same without flags, for views that read it more than once."""
    written = materialize(silver_snapshot(spark, sf_dir).select(*columns), "silver")
    return written.withColumn("is_current", F.lit(True))


@query(
    "gold_by_category",
    silver_sql(
        f"""SELECT market_cap_category, {_CORE_SQL}, CAST(as_of AS DATE) AS metric_date,
          'market_category_metrics' AS calculation_type
        FROM silver GROUP BY as_of, market_cap_category"""
    ),
)
def _gold_by_category(spark, sf_dir):
    gold = gold_by_category(silver_snapshot(spark, sf_dir), AS_OF).drop("metric_timestamp")
    gold = as_long(gold, "total_market_cap", "total_volume_24h")
    return rounded(rounded(gold, 6, *_CORE_AVERAGES), 12, "avg_volume_ratio")


@query(
    "gold_notebook",
    snapshot_sql(
        f"""SELECT {category_case(inclusive=True)} AS market_cap_category,
          CAST(count(*) AS BIGINT) AS num_coins,
          CAST(sum(market_cap) AS DOUBLE) AS total_market_cap,
          round(avg(market_cap), 3) AS avg_market_cap,
          CAST(sum(total_volume) AS DOUBLE) AS total_volume,
          round(avg(current_price), 6) AS avg_price,
          round(avg(price_change_percentage_24h), 6) AS avg_price_change_24h
        FROM snap GROUP BY 1"""
    ),
)
def _gold_notebook(spark, sf_dir):
    records = market_snapshot(spark, sf_dir, AS_OF).select(
        "id", "symbol", "name", "current_price", "market_cap", "total_volume", _CHANGE
    )
    gold = gold_simple(cast_if_present(basic_clean(records)), PART_CAPS_INCLUSIVE)
    return rounded(rounded(gold, 6, "avg_price", "avg_price_change_24h"), 3, "avg_market_cap")


@query(
    "gold_from_silver",
    silver_sql(
        f"""SELECT {category_case(inclusive=True)} AS market_cap_category,
          CAST(count(*) AS BIGINT) AS num_coins,
          CAST(sum(market_cap) AS BIGINT) AS total_market_cap,
          round(avg(market_cap), 3) AS avg_market_cap,
          CAST(sum(total_volume) AS BIGINT) AS total_volume,
          round(avg(price_change_percentage_24h), 6) AS avg_price_change_24h
        FROM silver GROUP BY 1"""
    ),
)
def _gold_from_silver(spark, sf_dir):
    gold = gold_from_current(silver_snapshot(spark, sf_dir), PART_CAPS_INCLUSIVE)
    gold = as_long(gold, "total_market_cap", "total_volume")
    return rounded(rounded(gold, 6, "avg_price_change_24h"), 3, "avg_market_cap")


_EXTENDED_SQL = f"""
  SELECT market_cap_category, {_CORE_SQL},
    round(avg(market_cap), 3) AS avg_market_cap,
    CAST(sum(total_volume) AS BIGINT) AS total_volume,
    round(avg(total_volume), 6) AS avg_volume,
    CAST(count(*) FILTER (price_change_percentage_24h > 0) AS BIGINT) AS num_gainers,
    CAST(count(*) FILTER (price_change_percentage_24h <= 0) AS BIGINT) AS num_losers,
    CAST(count(*) FILTER (is_price_anomaly) AS BIGINT) AS num_anomalies,
    CAST(count(*) FILTER (is_volume_spike) AS BIGINT) AS num_volume_spikes,
    round(sum(market_cap) / (SELECT sum(market_cap) FROM flagged) * 100, 9)
      AS category_dominance_pct,
    first(symbol ORDER BY price_change_percentage_24h DESC NULLS LAST, coin_id DESC)
      AS top_gainer_symbol,
    max(price_change_percentage_24h) AS top_gainer_change_pct,
    first(symbol ORDER BY price_change_percentage_24h ASC NULLS LAST, coin_id ASC)
      AS top_loser_symbol,
    min(price_change_percentage_24h) AS top_loser_change_pct,
    CAST(as_of AS DATE) AS metric_date
  FROM flagged GROUP BY as_of, market_cap_category"""
_GOLD_INPUT = (
    "symbol",
    "market_cap",
    "current_price",
    "price_volatility_24h",
    "volume_to_market_cap_ratio",
)


@query("gold_extended", silver_sql(_EXTENDED_SQL))
def _gold_extended(spark, sf_dir):
    gold = gold_extended(_current(spark, sf_dir, *_GOLD_INPUT), AS_OF)
    gold = gold.drop("metric_timestamp", "calculation_type", "created_at", "updated_at", "run_id")
    gold = as_long(gold, "total_market_cap", "total_volume_24h", "total_volume")
    gold = rounded(gold, 6, *_CORE_AVERAGES, "avg_volume")
    gold = rounded(rounded(gold, 3, "avg_market_cap"), 9, "category_dominance_pct")
    return rounded(gold, 12, "avg_volume_ratio")


@query(
    "market_summary",
    silver_sql(
        f"""SELECT metric_date, market_cap_category, num_coins, total_market_cap, avg_market_cap,
          total_volume, avg_price_change_24h, num_gainers, num_losers, category_dominance_pct
        FROM ({_EXTENDED_SQL})"""
    ),
)
def _market_summary(spark, sf_dir):
    gold = gold_extended(_current(spark, sf_dir, *_GOLD_INPUT), AS_OF)
    summary = as_long(views.market_summary(gold), "total_market_cap", "total_volume")
    summary = rounded(summary, 3, "avg_market_cap")
    return rounded(rounded(summary, 9, "category_dominance_pct"), 6, "avg_price_change_24h")


@query(
    "category_comparison",
    silver_sql(
        """SELECT market_cap_category, CAST(count(*) AS BIGINT) AS num_coins,
          CAST(sum(market_cap) AS BIGINT) AS total_market_cap,
          round(avg(price_change_percentage_24h), 6) AS avg_price_change_24h,
          round(avg(price_volatility_24h), 6) AS avg_volatility
        FROM silver GROUP BY 1"""
    ),
)
def _category_comparison(spark, sf_dir):
    gold = gold_by_category(silver_snapshot(spark, sf_dir), AS_OF)
    compared = as_long(views.category_comparison(gold, AS_OF.date()), "total_market_cap")
    return rounded(compared, 6, "avg_price_change_24h", "avg_volatility")


@query(
    "current_market_state",
    silver_sql(f"SELECT {', '.join(views.MARKET_STATE_COLUMNS)} FROM flagged"),
)
def _current_market_state(spark, sf_dir):
    return views.current_market_state(
        _current(spark, sf_dir, *views.MARKET_STATE_COLUMNS[:-3], "updated_at", ranked=True)
    )


@query(
    "top10_market_cap",
    silver_sql(
        """SELECT coin_id, symbol, name, current_price, market_cap, market_cap_rank,
          price_change_percentage_24h, volume_to_market_cap_ratio, distance_from_ath_pct
        FROM flagged ORDER BY market_cap_rank, coin_id LIMIT 10"""
    ),
)
def _top10(spark, sf_dir):
    return views.top_by_market_cap(
        _current(spark, sf_dir, *views.MARKET_STATE_COLUMNS[:-3], "updated_at", ranked=True)
    )


@query(
    "anomalies_detected",
    silver_sql(
        """SELECT coin_id, symbol, name, current_price, price_change_percentage_24h,
          is_price_anomaly, is_volume_spike, updated_at
        FROM flagged WHERE is_price_anomaly OR is_volume_spike"""
    ),
)
def _anomalies_detected(spark, sf_dir):
    return views.anomalies_detected(
        _current(spark, sf_dir, "symbol", "name", "current_price", "updated_at")
    )


@query(
    "top_movers",
    silver_sql(
        """SELECT coin_id, symbol, name, current_price, price_change_percentage_24h, market_cap,
          total_volume,
          CASE WHEN price_change_percentage_24h > 0 THEN 'GAINER' ELSE 'LOSER' END
            AS movement_type
        FROM silver WHERE price_change_percentage_24h IS NOT NULL
        ORDER BY abs(price_change_percentage_24h) DESC, coin_id LIMIT 20"""
    ),
)
def _top_movers(spark, sf_dir):
    return views.top_movers(silver_snapshot(spark, sf_dir).withColumn("is_current", F.lit(True)))


@query(
    "market_dominance",
    silver_sql(
        """SELECT coin_id, symbol, name, market_cap,
          CAST(market_cap AS DOUBLE) / CAST(sum(market_cap) OVER () AS DOUBLE) * 100
            AS market_dominance_pct,
          rank() OVER (ORDER BY market_cap DESC) AS dominance_rank
        FROM silver WHERE market_cap IS NOT NULL"""
    ),
)
def _market_dominance(spark, sf_dir):
    return views.market_dominance(_silver(spark, sf_dir, "coin_id", "symbol", "name", "market_cap"))


@query(
    "order_value_rank",
    """SELECT o_orderkey, o_orderdate,
         rank() OVER (ORDER BY o_orderdate DESC) AS recency_rank
       FROM orders""",
)
def _order_value_rank(spark, sf_dir):
    """Global rank over a column with many ties."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return global_rank(orders, "o_orderdate", output="recency_rank")


@query(
    "volatility_analysis",
    silver_sql(
        """SELECT market_cap_category, CAST(count(*) AS BIGINT) AS num_coins,
          round(avg(price_volatility_24h), 6) AS avg_volatility,
          round(stddev_samp(price_volatility_24h), 6) AS stddev_volatility,
          min(price_volatility_24h) AS min_volatility,
          max(price_volatility_24h) AS max_volatility,
          round(quantile_cont(price_volatility_24h, 0.5), 6) AS median_volatility
        FROM silver WHERE price_volatility_24h IS NOT NULL GROUP BY 1"""
    ),
)
def _volatility_analysis(spark, sf_dir):
    current = _silver(spark, sf_dir, "market_cap_category", "price_volatility_24h")
    result = views.volatility_analysis(current, group_limit=len(PART_CAPS.labels))
    return rounded(result, 6, "avg_volatility", "stddev_volatility", "median_volatility")


_SUMMARY_SQL = """SELECT CAST(updated_at AS DATE) AS summary_date, market_cap_category,
  CAST(count(*) AS BIGINT) AS num_coins,
  CAST(sum(market_cap) AS BIGINT) AS total_market_cap,
  CAST(sum(total_volume) AS BIGINT) AS total_volume,
  round(avg(current_price), 6) AS avg_price,
  round(avg(price_change_percentage_24h), 6) AS avg_price_change_24h,
  round(avg(price_volatility_24h), 6) AS avg_volatility,
  CAST(count(*) FILTER (is_price_anomaly) AS BIGINT) AS num_anomalies,
  CAST(count(*) FILTER (is_volume_spike) AS BIGINT) AS num_volume_spikes"""


@query("daily_market_summary", silver_sql(f"{_SUMMARY_SQL} FROM flagged GROUP BY 1, 2"))
def _daily_market_summary(spark, sf_dir):
    current = _current(
        spark, sf_dir, "market_cap", "current_price", "price_volatility_24h", "updated_at"
    )
    summary = as_long(views.daily_market_summary(current), "total_market_cap", "total_volume")
    return rounded(summary, 6, "avg_price", "avg_price_change_24h", "avg_volatility")


@query(
    "data_quality_metrics",
    silver_sql(
        f"""SELECT CAST(updated_at AS DATE) AS check_date, CAST(count(*) AS BIGINT) AS total_records,
          CAST(count(*) FILTER (current_price IS NULL) AS BIGINT) AS null_price_count,
          CAST(count(*) FILTER (market_cap IS NULL) AS BIGINT) AS null_market_cap_count,
          CAST(count(*) FILTER (current_price < 0) AS BIGINT) AS negative_price_count,
          CAST(count(*) FILTER (is_price_anomaly) AS BIGINT) AS anomaly_count,
          (1 - count(*) FILTER (current_price IS NULL) / CAST(count(*) AS DOUBLE)) * 100
            AS price_completeness_pct,
          TIMESTAMP '{AS_OF}' AS checked_at
        FROM flagged GROUP BY 1"""
    ),
)
def _data_quality_metrics(spark, sf_dir):
    return views.data_quality_metrics(
        _current(spark, sf_dir, "market_cap", "current_price", "updated_at"), AS_OF
    )


@query(
    "hand_off_view",
    silver_sql(
        """SELECT market_cap_category, CAST(count(*) AS BIGINT) AS num_coins,
          CAST(sum(total_volume) AS BIGINT) AS total_volume
        FROM silver GROUP BY 1"""
    ),
)
def _hand_off_view(spark, sf_dir):
    register(silver_snapshot(spark, sf_dir), "hand_off_silver")
    handed = spark.sql(
        "SELECT market_cap_category, count(*) AS num_coins, sum(total_volume) AS total_volume"
        " FROM hand_off_silver GROUP BY market_cap_category"
    )
    return as_long(handed, "total_volume")


# A sketch's choice is random, so the queries tell whether its rank is near, not its value.
NEAR = 0.01
QUARTILES = (0.25, 0.5, 0.75)


@query(
    "volatility_estimate",
    silver_sql(
        """SELECT market_cap_category, CAST(count(*) AS BIGINT) AS num_coins, true AS is_near
        FROM silver WHERE price_volatility_24h IS NOT NULL GROUP BY 1"""
    ),
)
def _volatility_estimate(spark, sf_dir):
    """Medians per class from sketches, by how far they lie from the exact rank."""
    value = "price_volatility_24h"
    silver = _silver(spark, sf_dir, views.CATEGORY, value)
    medians = views.volatility_estimate(silver).select(
        views.CATEGORY, F.col("median_volatility").alias("value"), F.lit(0.5).alias("fraction")
    )
    errors = rank_errors(silver, value, [views.CATEGORY], medians)
    near = (F.col("error") < NEAR).alias("is_near")
    return errors.select(views.CATEGORY, F.col("num_rows").alias("num_coins"), near)


@query(
    "price_quantiles_stored",
    """SELECT o_orderpriority, f.fraction, CAST(count(o_totalprice) AS BIGINT) AS num_rows,
         true AS is_near
       FROM orders, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) f(fraction)
       WHERE year(o_orderdate) >= 1995 GROUP BY 1, 2""",
)
def _price_quantiles_stored(spark, sf_dir):
    """Sketches per quarter and class are stored; quantiles over years merge them, unread rows."""
    groups = ["o_orderpriority"]
    quarter = F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("quarter")
    orders = table(spark, sf_dir, "orders").select(*groups, "o_orderdate", "o_totalprice", quarter)
    path = shared_dir(spark, "sketches")
    store_sketches(orders, path, "o_totalprice", "quarter", groups)
    late = F.col("quarter") >= F.lit("1995-01-01").cast("date")
    found = stored_quantiles(spark, path, QUARTILES, groups, late)
    rows = orders.filter(F.year("o_orderdate") >= 1995)
    errors = rank_errors(rows, "o_totalprice", groups, found.drop("num_rows"))
    near = (F.col("error") < NEAR).alias("is_near")
    kept = found.select(*groups, "fraction", "num_rows")
    return kept.join(errors.drop("num_rows"), [*groups, "fraction"]).select(
        *groups, "fraction", "num_rows", near
    )
