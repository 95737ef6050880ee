"""Bronze records to Silver rows: clean, project, rename, parse, derive."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.config import STRICT_CAPS, CapBuckets
from oreworks.functions import cap_category, ts_literal, utc_timestamp_sql
from oreworks.schemas import OPTIONAL_FIELDS

# The Silver columns taken from a record, the renamed ones and the time ones.
SILVER_COLUMNS = (
    "id",
    "symbol",
    "name",
    "current_price",
    "market_cap",
    "market_cap_rank",
    "total_volume",
    "high_24h",
    "low_24h",
    "price_change_24h",
    "price_change_percentage_24h",
    "price_change_percentage_7d_in_currency",
    "price_change_percentage_30d_in_currency",
    "circulating_supply",
    "total_supply",
    "max_supply",
    "ath",
    "ath_date",
    "atl",
    "atl_date",
    "last_updated",
    "extracted_at",
)
SILVER_NAMES = {
    "id": "coin_id",
    "price_change_percentage_7d_in_currency": "price_change_pct_7d",
    "price_change_percentage_30d_in_currency": "price_change_pct_30d",
}
TIME_COLUMNS = ("ath_date", "atl_date", "last_updated", "extracted_at")
NUMERIC_COLUMNS = ("current_price", "market_cap", "total_volume", "market_cap_rank")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every float column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.selectExpr(
        *[
            f"CASE WHEN NOT isnan(`{c}`) THEN `{c}` END AS `{c}`" if c in floats else f"`{c}`"
            for c in df.columns
        ]
    )


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct. Semi-structured columns cannot be compared; project them first."""
    return df.dropDuplicates()


def basic_clean(df: DataFrame, required: Sequence[str] = ("id", "current_price")) -> DataFrame:
    """Distinct rows whose required columns hold a value (NaN is not a value)."""
    return dedup_rows(nan_to_null(df).dropna(subset=list(required)))


def cast_if_present(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, target: str = "double"
) -> DataFrame:
    """Cast the listed columns the frame has; text that is no number gives null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast(target) for c in present}) if present else df


def zero_as_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Optional: zero and empty text become null."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    empty = {c: F.lit("") if c in text else F.lit(0) for c in columns}
    return df.withColumns({c: F.nullif(F.col(c), e) for c, e in empty.items()})


def project_silver(df: DataFrame) -> DataFrame:
    """Select, rename and parse. Optional feed columns are carried along when present."""
    wanted = SILVER_COLUMNS + tuple(c for c in OPTIONAL_FIELDS if c in df.columns)
    value = lambda c: utc_timestamp_sql(c) if c in TIME_COLUMNS else c
    return df.selectExpr(*[f"{value(c)} AS {SILVER_NAMES.get(c, c)}" for c in wanted])


# A zero divisor or a null gives null.
DERIVED_METRICS = {
    "price_volatility_24h": "try_divide(high_24h - low_24h, low_24h) * 100",
    "volume_to_market_cap_ratio": "try_divide(total_volume, market_cap)",
    "supply_percentage": "try_divide(circulating_supply, max_supply) * 100",
    "distance_from_ath_pct": "try_divide(ath - current_price, ath) * 100",
    "distance_from_atl_pct": "try_divide(current_price - atl, atl) * 100",
}


def derive_metrics(df: DataFrame, buckets: CapBuckets = STRICT_CAPS) -> DataFrame:
    """Volatility, size class, ratios and distances, in one projection."""
    return df.select(
        "*",
        *[F.expr(f"{e} AS {name}") for name, e in DERIVED_METRICS.items()],
        cap_category(F.col("market_cap"), buckets).alias("market_cap_category"),
    )


def to_silver(
    df: DataFrame, run_ts: datetime | Column, buckets: CapBuckets = STRICT_CAPS
) -> DataFrame:
    """Valid Bronze records to Silver rows, stamped with the time of the run or a Silver column."""
    stamp = run_ts if isinstance(run_ts, Column) else ts_literal(run_ts)
    return derive_metrics(project_silver(nan_to_null(df)), buckets).withColumns(
        {"silver_processed_at": stamp, "updated_at": stamp}
    )
