"""Bronze, Silver, Gold and run-log schemas, and the key contract of each table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The record layout of a landed market snapshot.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("market_cap", T.LongType()),
        T.StructField("market_cap_rank", T.IntegerType()),
        T.StructField("total_volume", T.LongType()),
        T.StructField("high_24h", T.DoubleType()),
        T.StructField("low_24h", T.DoubleType()),
        T.StructField("price_change_24h", T.DoubleType()),
        T.StructField("price_change_percentage_24h", T.DoubleType()),
        T.StructField("price_change_percentage_7d_in_currency", T.DoubleType()),
        T.StructField("price_change_percentage_30d_in_currency", T.DoubleType()),
        T.StructField("circulating_supply", T.DoubleType()),
        T.StructField("total_supply", T.DoubleType()),
        T.StructField("max_supply", T.DoubleType()),
        T.StructField("ath", T.DoubleType()),
        T.StructField("ath_date", T.StringType()),
        T.StructField("atl", T.DoubleType()),
        T.StructField("atl_date", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("extracted_at", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("extraction_page", T.IntegerType()),
    ]
)

# Optional record fields that only some feeds carry; Silver keeps them when present.
OPTIONAL_FIELDS = (
    "fully_diluted_valuation",
    "market_cap_change_24h",
    "market_cap_change_percentage_24h",
    "ath_change_percentage",
    "atl_change_percentage",
    "run_id",
)


@dataclass(frozen=True)
class TableContract:
    """Which columns must be filled and which together identify a row."""

    not_null: tuple[str, ...]
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


BRONZE_CONTRACT = TableContract(
    not_null=tuple(f.name for f in BRONZE_SCHEMA if not f.nullable), key=("id", "extracted_at")
)
SILVER_CONTRACT = TableContract(
    not_null=("coin_id", "symbol", "name", "valid_from"),
    key=("coin_id", "valid_from"),
    partition_by=("is_current",),
    cluster_by=("coin_id", "valid_from"),
)
GOLD_CONTRACT = TableContract(
    not_null=("metric_date", "market_cap_category"),
    key=("metric_date", "market_cap_category"),
    partition_by=("metric_date",),
    cluster_by=("metric_date", "market_cap_category"),
)
RUN_LOG_CONTRACT = TableContract(not_null=("run_id", "pipeline_name"), key=("run_id",))

# Gold columns that a repeated load of the same key replaces; the others keep their first value.
GOLD_UPDATED = (
    "num_coins",
    "total_market_cap",
    "total_volume_24h",
    "avg_price",
    "avg_price_change_24h",
    "avg_volatility",
    "avg_volume_ratio",
    "max_market_cap",
    "min_market_cap",
    "metric_timestamp",
    "calculation_type",
)
