"""The shared test tables seen as market snapshots, Bronze events and run logs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.config import CapBuckets
from oreworks.operators.anomalies import detect_anomalies
from oreworks.operators.ranking import global_rank
from oreworks.operators.silver import to_silver
from oreworks.sinks.files import materialize

# Limits that split the parts of the test tables into three classes.
PART_CAPS = CapBuckets(
    thresholds=((200_000_000, "Large Cap"), (120_000_000, "Mid Cap")), default="Small Cap"
)
PART_CAPS_INCLUSIVE = CapBuckets(
    thresholds=((200_000_000, "LARGE_CAP"), (120_000_000, "MID_CAP")),
    default="SMALL_CAP",
    inclusive=True,
)
PRICE_THRESHOLD = 0.5
AS_OF = datetime(2001, 11, 30)
SNAPSHOT_DAYS = (datetime(1995, 3, 31), datetime(1998, 6, 30), datetime(2001, 11, 30))
SNAPSHOT_SOURCE = "lineitem"
RECENT_DAYS = 90


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def priced_lines(spark: SparkSession, sf_dir: str, as_of: datetime) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").filter(f"l_shipdate <= TIMESTAMP_NTZ '{as_of}'")
    return shipped.selectExpr("*", "l_extendedprice / l_quantity AS px")


def recent_prices(lines: DataFrame, depth: int = 4) -> DataFrame:
    """The last ``depth`` prices of every part, newest first, as columns px1, px2, ...

    The row limit applies in each task before the shuffle, so a part that holds a third of all
    lines sends ``depth`` rows per task.
    """
    newest = """l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
        l_extendedprice DESC, l_quantity DESC"""
    numbered = lines.selectExpr(
        "l_partkey", "px", f"row_number() OVER (PARTITION BY l_partkey ORDER BY {newest}) AS nth"
    )
    return (
        numbered.filter(f"nth <= {depth}")
        .groupBy("l_partkey")
        .agg(*[F.expr(f"max(CASE WHEN nth = {i} THEN px END) AS px{i}") for i in _upto(depth)])
    )


def _upto(n: int) -> range:
    return range(1, n + 1)


def market_snapshot(
    spark: SparkSession, sf_dir: str, as_of: datetime, ranked: bool = False
) -> DataFrame:
    """One Bronze record per part from the order lines shipped up to ``as_of``.

    With ``ranked`` the market-cap rank is computed, which writes the records once and reads them
    back; otherwise the rank is null.
    """
    lines = priced_lines(spark, sf_dir, as_of)
    epoch = "TIMESTAMP_NTZ '1970-01-01'"
    recent = f"l_shipdate > TIMESTAMP_NTZ '{as_of - timedelta(days=RECENT_DAYS)}'"
    # Negated time: of equal prices the earliest counts.
    earliest = f"-timestampdiff(SECOND, {epoch}, l_shipdate)"
    figures = {
        "market_cap": "sum(CAST(round(l_extendedprice * 100) AS BIGINT))",
        "total_volume": "sum(CAST(l_quantity AS BIGINT))",
        "high_24h": f"max(CASE WHEN {recent} THEN px END)",
        "low_24h": f"min(CASE WHEN {recent} THEN px END)",
        "ath": "max(px)",
        "atl": "min(px)",
        "circulating_supply": "CAST(count(*) AS DOUBLE)",
        "last_ship": "max(l_shipdate)",
        "high_at": f"max(struct(px, {earliest} AS t)).t",
        "low_at": f"max(struct(-px, {earliest} AS t)).t",
    }
    totals = lines.groupBy("l_partkey").agg(*[F.expr(f"{e} AS {n}") for n, e in figures.items()])
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")

    def change(i: int) -> str:
        return f"try_divide(px1 - px{i}, px{i}) * 100"

    def iso(moment: str) -> str:
        return f"""date_format({moment}, "yyyy-MM-dd'T'HH:mm:ss'Z'")"""

    def at(seconds: str) -> str:
        return iso(f"{epoch} + make_dt_interval(0, 0, 0, -{seconds})")

    fields = {
        "id": "CAST(l_partkey AS STRING)",
        "symbol": "p_brand",
        "name": "p_name",
        "current_price": "px1",
        "market_cap": "market_cap",
        "market_cap_rank": "CAST(NULL AS INT)",
        "total_volume": "total_volume",
        "high_24h": "high_24h",
        "low_24h": "low_24h",
        "price_change_24h": "px1 - px2",
        "price_change_percentage_24h": change(2),
        "price_change_percentage_7d_in_currency": change(3),
        "price_change_percentage_30d_in_currency": change(4),
        "circulating_supply": "circulating_supply",
        "total_supply": "p_retailprice",
        "max_supply": "CAST(CASE WHEN p_size % 5 <> 0 THEN p_size END AS DOUBLE)",
        "ath": "ath",
        "ath_date": at("high_at"),
        "atl": "atl",
        "atl_date": at("low_at"),
        "last_updated": iso("last_ship"),
        "extracted_at": f"'{as_of.isoformat()}Z'",
        "source": f"'{SNAPSHOT_SOURCE}'",
        "extraction_page": "CAST(1 + floor(l_partkey / 100) AS INT)",
    }
    records = (
        totals.join(recent_prices(lines), "l_partkey")
        .join(part, "l_partkey")
        .selectExpr(*[f"{e} AS {n}" for n, e in fields.items()])
    )
    if not ranked:
        return records
    written = materialize(records.drop("market_cap_rank"), "snapshot")
    return _with_cap_rank(written).select(*fields)


def silver_snapshot(
    spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF, ranked: bool = False
) -> DataFrame:
    """The enriched snapshot, not yet flagged."""
    return to_silver(market_snapshot(spark, sf_dir, as_of, ranked), as_of, PART_CAPS)


def flagged_snapshot(
    spark: SparkSession,
    sf_dir: str,
    as_of: datetime = AS_OF,
    columns: tuple[str, ...] | None = None,
    ranked: bool = False,
) -> DataFrame:
    """The enriched and flagged snapshot as first versions, from a table written once.

    ``columns`` narrows the written table to what the caller uses.
    """
    silver = silver_snapshot(spark, sf_dir, as_of)
    if columns is not None:
        silver = silver.select(*columns)
    written = materialize(silver, "silver")
    flagged = detect_anomalies(written, PRICE_THRESHOLD, group_limit=len(PART_CAPS.labels))
    if ranked:
        flagged = _with_cap_rank(flagged.drop("market_cap_rank"))
    return flagged.withColumn("is_current", F.lit(True))


def _with_cap_rank(records: DataFrame) -> DataFrame:
    ranked = global_rank(records, "market_cap", output="market_cap_rank")
    return ranked.withColumn("market_cap_rank", F.col("market_cap_rank").cast("int"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw JSON text with run, extraction time and processed flag."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.to_json(F.struct("event_id", "event_type", "value", "props")).alias("record"),
        F.col("ts").alias("extracted_at"),
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.col("ts").alias("created_at"),
        (F.col("event_id") % 2 == 0).alias("processed"),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the Bronze layout, the payload parsed."""
    return event_records(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.try_parse_json("record").alias("payload"),
        "extracted_at",
        "run_id",
        F.lit("events").alias("source_system"),
        "created_at",
        "processed",
    )


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month as run-log rows; every tenth month counts as an empty, failed run."""
    month = F.trunc("o_orderdate", "month")
    runs = (
        table(spark, sf_dir, "orders")
        .groupBy(month.alias("month"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("o_orderstatus") != "P").alias("processed"),
            F.count_if(F.col("o_orderstatus") == "F").alias("loaded"),
            F.count_if(F.col("o_orderstatus") == "P").alias("failed"),
        )
    )
    empty = (F.year("month") * 12 + F.month("month")) % 10 == 0
    zero = lambda c: F.when(empty, F.lit(0)).otherwise(F.col(c)).cast("bigint")
    return runs.select(
        F.concat(F.lit("run_"), F.date_format("month", "yyyyMM")).alias("run_id"),
        F.lit("orders").alias("pipeline_name"),
        F.col("month").cast("timestamp_ntz").alias("run_date"),
        F.when(empty, "failed").otherwise("success").alias("status"),
        zero("n").alias("records_extracted"),
        zero("processed").alias("records_processed"),
        zero("loaded").alias("records_loaded"),
        zero("failed").alias("records_failed"),
        (F.col("n") * 1.5).cast("double").alias("execution_time_seconds"),
        F.when(empty, "no records").otherwise("").alias("error_message"),
        F.col("month").cast("timestamp_ntz").alias("created_at"),
    )
