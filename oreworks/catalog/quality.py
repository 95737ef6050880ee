"""Row validation, frame checks, contracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from oreworks.catalog.registry import query, rounded
from oreworks.catalog.sqltext import snapshot_sql
from oreworks.config import FrameRules, RowRules
from oreworks.operators import checks
from oreworks.operators.validation import flag_payloads, flag_rows
from oreworks.plans.adapters import AS_OF, market_snapshot, table
from oreworks.schemas import TableContract
from oreworks.sinks.contract_gate import write_checked
from oreworks.sinks.files import materialize, shared_dir
from oreworks.sinks.tables import read_quarantine, read_valid, write_flagged

EVENTS_AT = datetime(2024, 1, 31)

# Limits inside the range of the test data, so that every rule meets rows that break it.
SNAPSHOT_RULES = RowRules(
    not_null=("id", "high_24h", "max_supply", "high_24h"),
    ranges={"current_price": (500.0, 20_000.0)},
    non_negative=("market_cap", "price_change_24h"),
)
_ERRORS_SQL = """concat_ws('|',
    CASE WHEN high_24h IS NULL THEN 'high_24h_is_null' END,
    CASE WHEN max_supply IS NULL THEN 'max_supply_is_null' END,
    CASE WHEN current_price < 500 OR current_price > 20000
      THEN 'current_price_out_of_range' END,
    CASE WHEN price_change_24h < 0 THEN 'price_change_24h_negative' END)"""


def _flagged(spark, sf_dir):
    records = market_snapshot(spark, sf_dir, AS_OF).select(
        "id", "current_price", "market_cap", "high_24h", "max_supply", "price_change_24h"
    )
    return flag_rows(records, SNAPSHOT_RULES)


@query(
    "validate_rows",
    snapshot_sql(
        f"""SELECT id, current_price, {_ERRORS_SQL} AS errors, {_ERRORS_SQL} = '' AS is_valid
        FROM snap"""
    ),
)
def _validate_rows(spark, sf_dir):
    errors = F.array_join("validation_errors", "|").alias("errors")
    return _flagged(spark, sf_dir).select("id", "current_price", errors, "is_valid")


@query(
    "quarantine",
    snapshot_sql(
        f"""SELECT id, current_price, CASE WHEN {_ERRORS_SQL} = '' THEN 'valid' ELSE 'rejected' END
          AS kept_as, NULLIF({_ERRORS_SQL}, '') AS errors
        FROM snap"""
    ),
)
def _quarantine(spark, sf_dir):
    """Both halves of the split, read back from the table one write made."""
    path = shared_dir(spark, "validated")
    write_flagged(_flagged(spark, sf_dir), path)
    nothing = F.lit(None).cast("string")
    valid = read_valid(spark, path).select(
        "id", "current_price", F.lit("valid").alias("kept_as"), nothing.alias("errors")
    )
    rejected = read_quarantine(spark, path).select(
        "id",
        "current_price",
        F.lit("rejected").alias("kept_as"),
        F.array_join("validation_errors", "|").alias("errors"),
    )
    return valid.unionByName(rejected)


# The rule block as a configuration file would give it.
CONFIG_RULES = {
    "required_fields": ["id", "symbol", "name", "current_price"],
    "numeric_fields": ["current_price", "market_cap", "total_volume", "market_cap_rank"],
    "min_price": 0.0000001,
    "max_price": 300_000,
}


@query(
    "validate_rows_config",
    """SELECT o_orderkey, concat_ws('|',
         CASE WHEN TRY_CAST(o_orderpriority AS DOUBLE) IS NULL THEN 'market_cap_not_numeric' END,
         CASE WHEN TRY_CAST(o_orderstatus AS DOUBLE) IS NULL
           THEN 'market_cap_rank_not_numeric' END,
         CASE WHEN o_totalprice < 0.0000001 OR o_totalprice > 300000
           THEN 'current_price_out_of_range' END) AS errors
       FROM orders""",
)
def _validate_rows_config(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("symbol"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").cast("string").alias("current_price"),
        F.col("o_orderpriority").alias("market_cap"),
        F.col("o_custkey").alias("total_volume"),
        F.col("o_orderstatus").alias("market_cap_rank"),
    )
    flagged = flag_rows(records, RowRules.from_config(CONFIG_RULES))
    return flagged.select("o_orderkey", F.array_join("validation_errors", "|").alias("errors"))


@query(
    "payload_required",
    """SELECT CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_type = 'error' THEN 'symbol_is_null' ELSE '' END AS errors,
         event_type <> 'error' AS is_valid
       FROM events""",
)
def _payload_required(spark, sf_dir):
    """Error events carry no symbol field."""
    is_error = F.col("event_type") == "error"
    symbol = F.when(~is_error, F.col("event_type")).alias("symbol")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.parse_json(F.to_json(F.struct("event_id", symbol, "value"))).alias("payload"),
    )
    flagged = flag_payloads(events, "payload", ["event_id", "symbol", "value"])
    return flagged.select(
        "id", F.array_join("validation_errors", "|").alias("errors"), "is_valid"
    )


def _report_sql(*lines: tuple[str, str, str, str, str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{check}' AS "check", '{column}' AS column_name, '{metric}' AS metric,
          CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold,
          {passed} AS passed FROM t"""
        for check, column, metric, value, threshold, passed in lines
    )


def _completeness_lines(column: str, limit: float):
    nulls = f"count(*) FILTER ({column} IS NULL)"
    share = f"{nulls} * 1.0e0 / count(*) * 100"
    ok = f"{share} < {limit}"
    return (
        ("completeness", column, "null_count", nulls, "NULL", ok),
        ("completeness", column, "null_percentage", f"round({share}, 9)", str(limit), ok),
    )


@query(
    "dq_completeness",
    snapshot_sql("")
    + ", t AS (SELECT * FROM snap)\n"
    + _report_sql(
        *_completeness_lines("current_price", 30.0),
        *_completeness_lines("high_24h", 30.0),
        *_completeness_lines("max_supply", 30.0),
    ),
)
def _dq_completeness(spark, sf_dir):
    rules = FrameRules(
        required=("current_price", "high_24h", "max_supply", "no_such_column"), max_null_pct=30.0
    )
    return rounded(checks.quality_report(market_snapshot(spark, sf_dir, AS_OF), rules), 9, "value")


def _unique_lines(column: str):
    distinct = f"(count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END))"
    extra = f"count(*) - {distinct}"
    return (
        ("uniqueness", column, "total", "count(*)", "NULL", f"{extra} = 0"),
        ("uniqueness", column, "distinct", distinct, "NULL", f"{extra} = 0"),
        ("uniqueness", column, "duplicates", extra, "0", f"{extra} = 0"),
    )


@query(
    "dq_uniqueness",
    "WITH t AS (SELECT * FROM lineitem)\n"
    + _report_sql(
        *_unique_lines("l_orderkey"),
        *_unique_lines("l_partkey"),
        *_unique_lines("l_shipdate"),
        *_unique_lines("l_extendedprice"),
        *_unique_lines("l_returnflag"),
    ),
)
def _dq_uniqueness(spark, sf_dir):
    columns = ("l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_returnflag")
    return checks.quality_report(table(spark, sf_dir, "lineitem"), FrameRules(unique=columns))


@query(
    "dq_uniqueness_nulls",
    snapshot_sql("")
    + ", t AS (SELECT * FROM snap)\n"
    + _report_sql(*_unique_lines("id"), *_unique_lines("max_supply")),
)
def _dq_uniqueness_nulls(spark, sf_dir):
    """Null counts as one value."""
    rules = FrameRules(unique=("id", "max_supply"))
    records = market_snapshot(spark, sf_dir, AS_OF).select("id", "max_supply")
    return checks.quality_report(materialize(records, "records"), rules)


def _range_line(column: str, test: str):
    outside = f"count(*) FILTER ({test})"
    return ("range", column, "out_of_range_count", outside, "0", f"{outside} = 0")


@query(
    "dq_range",
    "WITH t AS (SELECT * FROM lineitem)\n"
    + _report_sql(
        _range_line("l_quantity", "l_quantity < 1 OR l_quantity > 50"),
        _range_line("l_extendedprice", "l_extendedprice > 90000"),
        _range_line("l_discount", "l_discount < 0.02"),
    ),
)
def _dq_range(spark, sf_dir):
    ranges = {
        "l_quantity": (1, 50),
        "l_extendedprice": (None, 90_000),
        "l_discount": (0.02, None),
        "no_such_column": (0, 1),
    }
    return checks.quality_report(table(spark, sf_dir, "lineitem"), FrameRules(ranges=ranges))


@query(
    "dq_freshness",
    "WITH t AS (SELECT * FROM events)\n"
    + _report_sql(
        (
            "freshness",
            "ts",
            "age_hours",
            f"round(date_diff('microsecond', max(ts), TIMESTAMP '{EVENTS_AT}') / 3.6e9, 9)",
            "24",
            f"date_diff('microsecond', max(ts), TIMESTAMP '{EVENTS_AT}') / 3.6e9 <= 24",
        )
    ),
)
def _dq_freshness(spark, sf_dir):
    rules = FrameRules(freshness="ts", max_age_hours=24)
    report = checks.quality_report(table(spark, sf_dir, "events"), rules, EVENTS_AT)
    return rounded(report, 9, "value")


@query(
    "validate_frame",
    snapshot_sql("")
    + ", t AS (SELECT * FROM snap)\n"
    + _report_sql(
        ("stats", "*", "total_rows", "count(*)", "NULL", "true"),
        ("stats", "*", "total_columns", "max(24)", "NULL", "true"),
        ("required", "no_such_column", "missing_column", "max(1)", "0", "false"),
        ("warning", "high_24h", "null_count", "count(*) FILTER (high_24h IS NULL)", "0", "true"),
        ("warning", "max_supply", "null_count", "count(*) FILTER (max_supply IS NULL)", "0", "true"),
    ),
)
def _validate_frame(spark, sf_dir):
    return checks.validate_frame(
        market_snapshot(spark, sf_dir, AS_OF),
        required=["id", "symbol", "no_such_column"],
        non_null=["id", "high_24h", "max_supply", "no_such_column"],
    )


@query(
    "validate_schema",
    """SELECT 'props' AS column_name, 'type_mismatch' AS issue, 'LongType()' AS expected,
         'StringType' AS actual, CAST(count(props) AS BIGINT) AS "rows",
         CAST(count(TRY_CAST(props AS BIGINT)) AS BIGINT) AS castable_rows FROM events
       UNION ALL
       SELECT 'value', 'type_mismatch', 'string', 'DoubleType', count(value),
         count(CAST(value AS VARCHAR)) FROM events
       UNION ALL
       SELECT 'market', 'missing', 'StringType', NULL, count(*), 0 FROM events""",
)
def _validate_schema(spark, sf_dir):
    expected = {
        "event_id": "LongType",
        "ts": "timestamp_ntz",
        "event_type": "StringType()",
        "props": "LongType()",
        "value": "string",
        "market": "StringType",
    }
    return checks.validate_schema(table(spark, sf_dir, "events"), expected)


@query(
    "zscore_anomalies",
    """WITH s AS (
         SELECT avg(value) AS mean, stddev_samp(value) AS std, count(*) AS total FROM events),
       t AS (
         SELECT count(*) FILTER (abs((value - mean) / std) > 2.5) AS n, max(mean) AS mean,
           max(std) AS std, max(total) AS total
         FROM events, s)
       SELECT 'zscore' AS "check", 'value' AS column_name, metric, round(value, 6) AS value,
         threshold, n = 0 AS passed
       FROM (
         SELECT 'anomaly_count' AS metric, CAST(n AS DOUBLE) AS value,
           CAST(0 AS DOUBLE) AS threshold, n FROM t
         UNION ALL SELECT 'anomaly_percentage', n * 1.0e0 / total * 100, NULL, n FROM t
         UNION ALL SELECT 'mean', mean, NULL, n FROM t
         UNION ALL SELECT 'std', std, NULL, n FROM t
         UNION ALL SELECT 'z_threshold', 2.5, NULL, n FROM t)""",
)
def _zscore_anomalies(spark, sf_dir):
    """The text column and the constant column are left out of the report."""
    events = table(spark, sf_dir, "events").withColumn("one", F.lit(1.0))
    report = checks.zscore_report(events, ["value", "event_type", "one"], z_threshold=2.5)
    return rounded(report, 6, "value")


@query(
    "zscore_examples",
    """WITH s AS (
         SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq,
           avg(l_extendedprice) AS mp, stddev_samp(l_extendedprice) AS sp FROM lineitem),
       u AS (
         SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS column_name,
           l_quantity AS anomaly_value FROM lineitem, s WHERE abs((l_quantity - mq) / sq) > 1.6
         UNION ALL
         SELECT l_orderkey, l_linenumber, l_partkey, 'l_extendedprice', l_extendedprice
           FROM lineitem, s WHERE abs((l_extendedprice - mp) / sp) > 1.6)
       SELECT * FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY column_name
           ORDER BY l_orderkey, l_linenumber, l_partkey, anomaly_value) AS INTEGER) AS position FROM u)
       WHERE position <= 10""",
)
def _zscore_examples(spark, sf_dir):
    return checks.zscore_examples(
        table(spark, sf_dir, "lineitem"),
        ["l_quantity", "l_extendedprice", "l_returnflag"],
        order_by=["l_orderkey", "l_linenumber", "l_partkey"],
        z_threshold=1.6,
    )


@query(
    "contract_nulls",
    snapshot_sql("")
    + ", t AS (SELECT * FROM snap)\n"
    + _report_sql(
        *[
            (
                "not_null",
                c,
                "null_count",
                f"count(*) FILTER ({c} IS NULL)",
                "0",
                f"count(*) FILTER ({c} IS NULL) = 0",
            )
            for c in ("id", "symbol", "low_24h", "max_supply")
        ]
    ),
)
def _contract_nulls(spark, sf_dir):
    contract = TableContract(not_null=("id", "symbol", "low_24h", "max_supply"), key=("id",))
    return checks.contract_nulls(market_snapshot(spark, sf_dir, AS_OF), contract)


@query(
    "contract_pk",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def _contract_pk(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return checks.contract_key_violations(lines, ["l_orderkey", "l_linenumber"])


# Days of the first of two batches; the second one brings all days.
_FIRST_DAYS = "DATE '2024-01-10'"
_USER_DAY = TableContract(
    not_null=("user_id", "event_type"), key=("user_id", "day"), partition_by=("day",), cluster_by=("user_id",)
)


@query(
    "contract_write",
    f"""WITH e AS (
         SELECT event_id, user_id, CAST(ts AS DATE) AS day, nullif(event_type, 'error') AS event_type FROM events
       ), b AS (
         SELECT 1 AS batch, * FROM e WHERE day < {_FIRST_DAYS} UNION ALL SELECT 2, * FROM e
       ), r AS (
         SELECT *, event_type IS NOT NULL AND row_number() OVER (
                  PARTITION BY batch, user_id, day, event_type IS NULL ORDER BY event_id DESC) > 1 AS repeated,
                event_type IS NOT NULL AND batch = 2 AND day < {_FIRST_DAYS} AS held
         FROM b
       )
       SELECT batch, event_id, day, concat_ws('|',
                CASE WHEN event_type IS NULL THEN 'event_type_is_null' END,
                CASE WHEN repeated THEN 'key_repeated' END,
                CASE WHEN held THEN 'key_exists' END) AS errors
       FROM r""",
)
def _contract_write(spark, sf_dir):
    """Two batches under a contract: the newest event per user and day, the others with their reasons."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("ts").cast("date").alias("day"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
    )
    path, rejected = shared_dir(spark, "user-days"), shared_dir(spark, "user-days-rejected")
    batches = (events.filter(F.col("day") < F.expr(_FIRST_DAYS)), events)
    for number, batch in enumerate(batches, 1):
        marked = batch.withColumn("batch", F.lit(number))
        write_checked(marked, _USER_DAY, path, rejected, f"batch{number}", newest=["event_id"])
    kept = spark.read.parquet(path).withColumn("errors", F.lit(""))
    aside = spark.read.parquet(rejected).withColumn("errors", F.array_join("validation_errors", "|"))
    columns = ["batch", "event_id", "day", "errors"]
    return kept.select(columns).unionByName(aside.select(columns))
