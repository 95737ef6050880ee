"""Bronze table of raw payloads: landing, processed ledger, archiving, statistics.

The payload is semi-structured (VARIANT). The table is split by ``accepted`` and ``ingest_date``,
so that landing is one write, and reads and archiving touch only the days they need.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.functions import ts_literal
from oreworks.operators.skew import salted_join
from oreworks.sinks.files import child_names, move_files
from oreworks.sinks.tables import with_flag, write_table

PARTITIONS = ("accepted", "ingest_date")


def as_bronze(raw: DataFrame, source_system: str) -> DataFrame:
    """Raw ``(run_id, extracted_at, record)`` text rows to the Bronze layout.

    The id is a digest of the content, so landing the same record again gives the same id. Text
    that is no JSON is kept as ``rejected_text`` and marked as not accepted.
    """
    parsed = raw.withColumn("payload", F.try_parse_json("record"))
    given = set(raw.columns)
    return parsed.selectExpr(
        "sha2(concat_ws('|', run_id, CAST(extracted_at AS STRING), record), 256) AS id",
        "payload",
        "CASE WHEN payload IS NULL THEN record END AS rejected_text",
        "extracted_at",
        "run_id",
        f"'{source_system}' AS source_system",
        "created_at" if "created_at" in given else "extracted_at AS created_at",
        "processed" if "processed" in given else "false AS processed",
        "payload IS NOT NULL AS accepted",
        "CAST(extracted_at AS DATE) AS ingest_date",
    )


def land_payloads(bronze: DataFrame, path: str) -> dict[str, int]:
    """Append Bronze rows; returns accepted and rejected counts seen by the write itself."""
    accepted = F.col("accepted")
    counts = {"accepted": F.count_if(accepted), "rejected": F.count_if(~accepted)}
    return write_table(bronze, path, "append", PARTITIONS, counts=counts)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    rows = with_flag(spark.read.parquet(path), "accepted")
    return rows.filter("accepted").drop("accepted", "rejected_text")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    rows = with_flag(spark.read.parquet(path), "accepted")
    return rows.filter("NOT accepted").drop("accepted", "payload")


def mark_processed(spark: SparkSession, ledger: str, run_id: str, at: datetime) -> None:
    """Record that the rows of a run are done. Bronze itself is never rewritten for this."""
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), ts_literal(at).alias("processed_at"))
    row.write.mode("append").parquet(ledger)


def unprocessed(
    bronze: DataFrame, done_runs: DataFrame | None, newest_first: bool = False
) -> DataFrame:
    """Rows neither flagged as processed nor part of a run in the ledger.

    A single run may be a large part of Bronze, so the join with the ledger is salted.
    """
    rows = bronze.filter(~F.col("processed"))
    if done_runs is not None:
        runs = done_runs.select("run_id").distinct()
        rows = salted_join(rows, runs, ["run_id"], "left_anti", ["id"])
    return rows.orderBy(F.desc("created_at"), "id") if newest_first else rows


# Fixed value: the folder of rows whose partition column is null.
_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def archive_bronze(
    spark: SparkSession, path: str, archive_path: str, as_of: datetime, days: int = 90
) -> int:
    """Move the days older than ``days`` before ``as_of`` to the archive; returns rows moved.

    Only files are moved, within one file system. Rows that arrive late for a day that is in the
    archive already join it with the next call.
    """
    cutoff = as_of.date() - timedelta(days=days)
    old = spark.read.parquet(path).filter(F.col("ingest_date") < F.lit(cutoff))
    rows = old.count()  # from file footers
    for group in child_names(spark, path):
        if not group.startswith("accepted="):
            continue
        for day in child_names(spark, f"{path}/{group}"):
            name, _, value = day.partition("=")
            if name != "ingest_date" or value == _NULL_DAY:
                continue  # rows without a day are never old
            if date.fromisoformat(value) < cutoff:
                move_files(spark, f"{path}/{group}/{day}", f"{archive_path}/{group}/{day}")
    return rows


def extraction_stats(bronze: DataFrame) -> DataFrame:
    """Records, processed records, first and last extraction per run and source."""
    return bronze.groupBy("run_id", "source_system").agg(
        F.count("*").alias("record_count"),
        F.count_if("processed").alias("processed_count"),
        F.min("extracted_at").alias("first_extracted_at"),
        F.max("extracted_at").alias("last_extracted_at"),
    )
