"""Incremental Bronze to Silver: every landed file is taken exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oreworks.config import STRICT_CAPS, CapBuckets, RowRules
from oreworks.operators.validation import flag_rows
from oreworks.plans.batch_run import silver_observations
from oreworks.schemas import BRONZE_SCHEMA
from oreworks.sinks.files import freed_after
from oreworks.sinks.silver_store import BUCKETS, SnapshotLimits, merge_observations
from oreworks.sinks.tables import read_valid, write_flagged
from oreworks.sources.landing import narrow_longs, wide_longs


def incremental_silver(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    rules: RowRules,
    price_threshold: float,
    buckets: CapBuckets = STRICT_CAPS,
    schema: T.StructType = BRONZE_SCHEMA,
    max_files: int | None = None,
    multi_line: bool = False,
    store_buckets: int = BUCKETS,
) -> None:
    """Process the files that arrived since the last call, then stop.

    The checkpoint remembers the files. Every record counts at its own extraction time, so the
    history does not depend on how many files a micro-batch happens to take, nor on their order:
    late records are merged at their place in time, of records with equal key and time the newest
    counts, and volume spikes are told by all records of a snapshot, also those of other
    micro-batches. A micro-batch that is repeated after a failure carries the same batch number and so
    replaces its own run. What it writes in between is freed with it. Valid records without a readable time
    go to ``<root>_rejected``. ``multi_line`` reads files that hold one JSON array each instead of
    lines; empty files and files without a valid row make no run.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        run = f"b{batch_id:012d}"
        records = narrow_longs(batch, schema).drop("fraction_lost")
        validated = f"{root}_validated/run_id={run}"
        flagged = flag_rows(records, rules)
        write_flagged(flagged, validated)
        valid = read_valid(spark, validated, flagged.schema)
        with freed_after(spark):
            rows = silver_observations(valid, price_threshold, buckets)
            merge_observations(spark, root, rows, run, limits=SnapshotLimits(), buckets=store_buckets)

    reader = spark.readStream.schema(wide_longs(schema)).option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.json(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
