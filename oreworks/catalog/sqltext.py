"""SQL building blocks: the snapshot, Silver and flag steps as common table expressions."""

from __future__ import annotations

from datetime import datetime

from oreworks.plans.adapters import AS_OF


def snapshot_ctes(*days: datetime) -> str:
    """``snap``: Bronze records per snapshot day, written from the definition of the adapter."""
    values = ", ".join(f"(TIMESTAMP '{d}')" for d in (days or (AS_OF,)))
    change = lambda i: f"(px1 - px{i}) / NULLIF(px{i}, 0) * 100"
    return f"""
days(as_of) AS (VALUES {values}),
lines AS (
  SELECT as_of, lineitem.*, l_extendedprice / l_quantity AS px
  FROM lineitem JOIN days ON l_shipdate <= as_of),
numbered AS (
  SELECT as_of, l_partkey, px, row_number() OVER (
    PARTITION BY as_of, l_partkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
             l_extendedprice DESC, l_quantity DESC) AS nth
  FROM lines),
recent AS (
  SELECT as_of, l_partkey,
    max(px) FILTER (nth = 1) AS px1, max(px) FILTER (nth = 2) AS px2,
    max(px) FILTER (nth = 3) AS px3, max(px) FILTER (nth = 4) AS px4
  FROM numbered GROUP BY ALL),
figures AS (
  SELECT as_of, l_partkey,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS market_cap,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_volume,
    max(px) FILTER (l_shipdate > as_of - INTERVAL 90 DAY) AS high_24h,
    min(px) FILTER (l_shipdate > as_of - INTERVAL 90 DAY) AS low_24h,
    max(px) AS ath, min(px) AS atl,
    CAST(count(*) AS DOUBLE) AS circulating_supply,
    max(l_shipdate) AS last_updated
  FROM lines GROUP BY ALL),
extremes AS (
  SELECT l.as_of, l.l_partkey,
    min(l_shipdate) FILTER (px = ath) AS ath_date, min(l_shipdate) FILTER (px = atl) AS atl_date
  FROM lines l JOIN figures f ON l.as_of = f.as_of AND l.l_partkey = f.l_partkey
  GROUP BY ALL),
snap AS (
  SELECT f.as_of, CAST(f.l_partkey AS VARCHAR) AS id, p_brand AS symbol, p_name AS name,
    px1 AS current_price, market_cap,
    CAST(rank() OVER (PARTITION BY f.as_of ORDER BY market_cap DESC) AS INTEGER)
      AS market_cap_rank,
    total_volume, high_24h, low_24h,
    px1 - px2 AS price_change_24h, {change(2)} AS price_change_percentage_24h,
    {change(3)} AS price_change_pct_7d, {change(4)} AS price_change_pct_30d,
    circulating_supply, p_retailprice AS total_supply,
    CAST(CASE WHEN p_size % 5 <> 0 THEN p_size END AS DOUBLE) AS max_supply,
    ath, ath_date, atl, atl_date, last_updated, f.as_of AS extracted_at,
    CAST(1 + floor(f.l_partkey / 100) AS INTEGER) AS extraction_page
  FROM figures f
  JOIN recent r ON f.as_of = r.as_of AND f.l_partkey = r.l_partkey
  JOIN extremes e ON f.as_of = e.as_of AND f.l_partkey = e.l_partkey
  JOIN part ON p_partkey = f.l_partkey)"""


def category_case(inclusive: bool = False) -> str:
    op = ">=" if inclusive else ">"
    labels = (
        ("LARGE_CAP", "MID_CAP", "SMALL_CAP")
        if inclusive
        else ("Large Cap", "Mid Cap", "Small Cap")
    )
    return (
        f"CASE WHEN market_cap {op} 200000000 THEN '{labels[0]}' "
        f"WHEN market_cap {op} 120000000 THEN '{labels[1]}' ELSE '{labels[2]}' END"
    )


def silver_ctes(*days: datetime) -> str:
    """``silver``: derived metrics, and ``flagged``: with both anomaly flags."""
    return (
        snapshot_ctes(*days)
        + f""",
silver AS (
  SELECT * EXCLUDE (id), id AS coin_id,
    (high_24h - low_24h) / NULLIF(low_24h, 0) * 100 AS price_volatility_24h,
    {category_case()} AS market_cap_category,
    total_volume / CAST(NULLIF(market_cap, 0) AS DOUBLE) AS volume_to_market_cap_ratio,
    circulating_supply / NULLIF(max_supply, 0) * 100 AS supply_percentage,
    (ath - current_price) / NULLIF(ath, 0) * 100 AS distance_from_ath_pct,
    (current_price - atl) / NULLIF(atl, 0) * 100 AS distance_from_atl_pct,
    as_of AS updated_at
  FROM snap),
flagged AS (
  SELECT *,
    coalesce(abs(price_change_percentage_24h) > 50, false) AS is_price_anomaly,
    coalesce(total_volume > avg(total_volume) OVER c + 3 * stddev_samp(total_volume) OVER c,
             false) AS is_volume_spike
  FROM silver
  WINDOW c AS (PARTITION BY as_of, market_cap_category))"""
    )


def silver_sql(body: str, *days: datetime) -> str:
    return f"WITH {silver_ctes(*days)}\n{body}"


def snapshot_sql(body: str, *days: datetime) -> str:
    return f"WITH {snapshot_ctes(*days)}\n{body}"


def versions_sql(body: str, *days: datetime) -> str:
    """``versions``: the type-2 history over successive snapshots."""
    ctes = (
        silver_ctes(*days)
        + """,
compared AS (
  SELECT *,
    lag(as_of) OVER k AS before_as_of, lag(current_price) OVER k AS before_price,
    lag(market_cap) OVER k AS before_cap, lag(total_volume) OVER k AS before_volume
  FROM flagged WINDOW k AS (PARTITION BY coin_id ORDER BY as_of)),
opened AS (
  SELECT * FROM compared
  WHERE before_as_of IS NULL OR current_price IS DISTINCT FROM before_price
     OR market_cap IS DISTINCT FROM before_cap OR total_volume IS DISTINCT FROM before_volume),
versions AS (
  SELECT *, as_of AS valid_from,
    lead(as_of) OVER (PARTITION BY coin_id ORDER BY as_of) AS valid_to,
    lead(as_of) OVER (PARTITION BY coin_id ORDER BY as_of) IS NULL AS is_current
  FROM opened)"""
    )
    return f"WITH {ctes}\n{body}"
