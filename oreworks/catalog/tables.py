"""Table maintenance and run log queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from oreworks.catalog.registry import query
from oreworks.config import RowRules
from oreworks.operators.validation import flag_rows
from oreworks.plans import views
from oreworks.plans.adapters import order_runs, table
from oreworks.sinks.files import shared_dir
from oreworks.sinks.run_log import log_run, run_record
from oreworks.sinks.tables import compact_zorder, read_table, write_flagged, write_table

_LINE_COLUMNS = "l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate"


@query("zorder_compact", f"SELECT {_LINE_COLUMNS} FROM lineitem")
def _zorder_compact(spark, sf_dir):
    """Same content, rewritten so that files are narrow in part and ship date together."""
    path = shared_dir(spark, "zorder")
    compact_zorder(spark, f"{sf_dir}/lineitem.parquet", path, ["l_partkey", "l_shipdate"])
    return spark.read.parquet(path).select(*_LINE_COLUMNS.split(", "))


@query(
    "table_write_modes",
    """SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderpriority, o_orderstatus
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL
       SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderstatus
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def _table_write_modes(spark, sf_dir):
    """Overwrite replaces rows and schema, append adds rows and may add a column."""
    orders = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "modes")
    write_table(orders.select("o_orderkey", "o_custkey"), path, "overwrite")
    first = orders.filter("o_orderstatus = 'F'")
    write_table(
        first.select("o_orderkey", "o_totalprice", "o_orderstatus"),
        path,
        "overwrite",
        partition_by=["o_orderstatus"],
        sort_by=["o_orderkey"],
    )
    second = orders.filter("o_orderstatus <> 'F'")
    write_table(
        second.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"),
        path,
        "append",
        partition_by=["o_orderstatus"],
        sort_by=["o_orderkey"],
    )
    return read_table(spark, path).select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )


@query(
    "run_metadata",
    """SELECT 'run_1' AS run_id, 'orders' AS pipeline_name, TIMESTAMP '2024-02-01' AS run_date,
         'success' AS status, CAST(count(*) AS BIGINT) AS records_extracted,
         CAST(count(*) FILTER (o_totalprice <= 300000) AS BIGINT) AS records_processed,
         CAST(0 AS BIGINT) AS records_loaded,
         CAST(count(*) FILTER (o_totalprice > 300000) AS BIGINT) AS records_failed,
         CAST(0 AS DOUBLE) AS execution_time_seconds, '' AS error_message,
         300000 AS max_price
       FROM orders""",
)
def _run_metadata(spark, sf_dir):
    """The counters come from the write itself, not from extra counting jobs."""
    rules = RowRules(ranges={"o_totalprice": (0.0, 300_000.0)}, non_negative=())
    counts = write_flagged(
        flag_rows(table(spark, sf_dir, "orders"), rules), shared_dir(spark, "run")
    )
    counters = {
        "records_extracted": counts["valid"] + counts["invalid"],
        "records_processed": counts["valid"],
        "records_failed": counts["invalid"],
    }
    path = shared_dir(spark, "run-log")
    record = run_record(
        spark,
        "run_1",
        "orders",
        datetime(2024, 2, 1),
        "success",
        counters,
        config={"max_price": 300000},
    )
    log_run(record, path)
    limit = F.try_variant_get(F.col("config_snapshot"), "$.max_price", "int").alias("max_price")
    return spark.read.parquet(path).select(
        "run_id",
        "pipeline_name",
        "run_date",
        "status",
        "records_extracted",
        "records_processed",
        "records_loaded",
        "records_failed",
        "execution_time_seconds",
        "error_message",
        limit,
    )


_RUNS_SQL = """WITH months AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n,
    count(*) FILTER (o_orderstatus <> 'P') AS processed,
    count(*) FILTER (o_orderstatus = 'F') AS loaded,
    count(*) FILTER (o_orderstatus = 'P') AS failed
  FROM orders GROUP BY 1),
runs AS (
  SELECT *, (year(month) * 12 + month(month)) % 10 = 0 AS is_empty FROM months),
history AS (
  SELECT 'run_' || strftime(month, '%Y%m') AS run_id, 'orders' AS pipeline_name,
    CAST(month AS TIMESTAMP) AS run_date,
    CASE WHEN is_empty THEN 'failed' ELSE 'success' END AS status,
    CAST(CASE WHEN is_empty THEN 0 ELSE n END AS BIGINT) AS records_extracted,
    CAST(CASE WHEN is_empty THEN 0 ELSE processed END AS BIGINT) AS records_processed,
    CAST(CASE WHEN is_empty THEN 0 ELSE loaded END AS BIGINT) AS records_loaded,
    CAST(CASE WHEN is_empty THEN 0 ELSE failed END AS BIGINT) AS records_failed,
    CAST(round(CAST(n AS DECIMAL(18, 4)) * 0.025, 2) AS DOUBLE) AS execution_time_minutes,
    CASE WHEN is_empty THEN 0 ELSE round(CAST(processed AS DOUBLE) / n * 100, 2) END
      AS success_rate_pct,
    CASE WHEN is_empty THEN 'no records' ELSE '' END AS error_message,
    CAST(month AS TIMESTAMP) AS created_at
  FROM runs)
SELECT * FROM history"""


@query("run_history", _RUNS_SQL)
def _run_history(spark, sf_dir):
    return views.run_history(order_runs(spark, sf_dir))


@query("run_health", f"{_RUNS_SQL} ORDER BY run_date DESC, run_id LIMIT 10")
def _run_health(spark, sf_dir):
    return views.run_health(order_runs(spark, sf_dir))
