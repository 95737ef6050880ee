"""Log of runs, one row per run."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.functions import ts_literal
from oreworks.schemas import RUN_LOG_CONTRACT
from oreworks.sinks.tables import replace_partitions

_LOG_KEY = "log_key"
COUNTERS = ("records_extracted", "records_processed", "records_loaded", "records_failed")


def run_record(
    spark: SparkSession,
    run_id: str,
    pipeline_name: str,
    run_date: datetime,
    status: str,
    counters: Mapping[str, int] | None = None,
    execution_time: float = 0.0,
    error_message: str = "",
    config: Mapping | None = None,
    started_at: datetime | None = None,
    completed_at: datetime | None = None,
) -> DataFrame:
    """One run as one row; counters that were not given are zero."""
    counters = counters or {}
    time = lambda t: ts_literal(t) if t else F.lit(None).cast("timestamp_ntz")
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        ts_literal(run_date).alias("run_date"),
        F.lit(status).alias("status"),
        *[F.lit(int(counters.get(c, 0))).cast("bigint").alias(c) for c in COUNTERS],
        F.lit(float(execution_time)).alias("execution_time_seconds"),
        F.lit(error_message).alias("error_message"),
        F.parse_json(F.lit(json.dumps(config or {}, default=str))).alias("config_snapshot"),
        time(started_at).alias("started_at"),
        time(completed_at).alias("completed_at"),
        time(completed_at or run_date).alias("created_at"),
    )


def log_run(record: DataFrame, path: str) -> None:
    """Write runs to the log. A repeated run takes the place of its earlier row.

    Each run has a folder of its own, named by the contract's key; the letter before the id keeps
    the name text. A row that lacks what the contract wants filled fails the write.
    """
    (key,) = RUN_LOG_CONTRACT.key
    filled = record.withColumns({c: _filled(c) for c in RUN_LOG_CONTRACT.not_null})
    keyed = filled.withColumn(_LOG_KEY, F.concat(F.lit("k"), F.col(key)))
    replace_partitions(keyed, path, _LOG_KEY)


def _filled(column: str) -> Column:
    message = F.raise_error(F.lit(f"the run log needs {column}"))
    return F.when(F.col(column).isNull(), message).otherwise(F.col(column))
