"""One batch from landed files to Gold, each table written once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.config import STRICT_CAPS, CapBuckets, RowRules
from oreworks.operators.anomalies import detect_anomalies, flag_price_anomalies
from oreworks.operators.gold import gold_extended
from oreworks.operators.silver import to_silver
from oreworks.operators.validation import flag_rows
from oreworks.plans.gold_store import refresh_daily_summary, upsert_gold
from oreworks.schemas import BRONZE_CONTRACT, GOLD_CONTRACT, SILVER_CONTRACT
from oreworks.sinks.contract_gate import keep_filled
from oreworks.sinks.files import materialize
from oreworks.sinks.run_log import log_run, run_record
from oreworks.sinks.silver_store import CHANGES, merge_batch, read_current
from oreworks.sinks.tables import read_quarantine, read_valid, write_flagged
from oreworks.sources.landing import add_load_audit


@dataclass(frozen=True)
class Layout:
    """Where the tables live, all under one root every executor reaches."""

    root: str

    @property
    def validated(self) -> str:
        return f"{self.root}/bronze_validated"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def summary(self) -> str:
        return f"{self.root}/daily_market_summary"

    @property
    def broken(self) -> str:
        """Silver and Gold rows that break the contract of their table, by run."""
        return f"{self.root}/contract_rejected"

    @property
    def runs(self) -> str:
        return f"{self.root}/run_log"


def silver_batch(
    spark: SparkSession,
    validated_path: str,
    run_ts: datetime,
    price_threshold: float,
    buckets: CapBuckets = STRICT_CAPS,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Enrich and flag the valid rows of a validated table."""
    silver = to_silver(read_valid(spark, validated_path, schema), run_ts, buckets)
    # The spike limits need a second read, so the derived rows are written once.
    silver = materialize(silver, "silver-batch")
    return detect_anomalies(silver, price_threshold, group_limit=len(buckets.labels))


def silver_observations(
    valid: DataFrame, price_threshold: float, buckets: CapBuckets = STRICT_CAPS
) -> DataFrame:
    """Valid rows of several snapshots, each stamped at its own time and with its price flag.

    Volume spikes need all rows of a snapshot; the store tells them (``SnapshotLimits``).
    """
    silver = to_silver(valid, F.col("extracted_at"), buckets)
    return flag_price_anomalies(silver, price_threshold)


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _record(spark, run_id, name, run_ts, status, counters, started, error="") -> DataFrame:
    """The run with the time it took so far and the counters reached."""
    ended = _now()
    seconds = (ended - started).total_seconds()
    times = {"execution_time": seconds, "started_at": started, "completed_at": ended}
    return run_record(spark, run_id, name, run_ts, status, counters, error_message=error, **times)


def run_batch(
    spark: SparkSession,
    records: DataFrame,
    layout: Layout,
    run_ts: datetime,
    rules: RowRules,
    price_threshold: float,
    buckets: CapBuckets = STRICT_CAPS,
    name: str = "market_snapshot",
) -> dict[str, int]:
    """Take Bronze records through all layers, and log the run, also when it fails.

    A batch without a valid row is logged and changes nothing else. Rows reach a table only where
    they keep its contract: records without a required Bronze field count as failed, Silver and Gold
    rows that lack one go to ``layout.broken``.
    """
    started = _now()
    run_id = run_ts.strftime("%Y%m%d%H%M%S")
    counters: dict[str, int] = {}
    try:
        audited = add_load_audit(records, run_ts).drop("fraction_lost")
        validated = f"{layout.validated}/run_id={run_id}"
        flagged = flag_rows(audited, rules.with_required(BRONZE_CONTRACT.not_null))
        counts = write_flagged(flagged, validated)
        counters = {
            "records_extracted": counts["valid"] + counts["invalid"],
            "records_processed": counts["valid"],
            "records_failed": counts["invalid"],
        }
        if not counts["valid"]:
            log_run(_record(spark, run_id, name, run_ts, "success", counters, started), layout.runs)
            return counters | {"records_loaded": 0} | dict.fromkeys(CHANGES, 0)
        batch = silver_batch(spark, validated, run_ts, price_threshold, buckets, flagged.schema)
        batch = keep_filled(batch, SILVER_CONTRACT, f"{layout.broken}/silver", run_id, later=("valid_from",))
        changes = merge_batch(spark, layout.silver, batch, run_ts)
        current = read_current(spark, layout.silver)
        gold = gold_extended(current, run_ts, run_id)
        gold = keep_filled(gold, GOLD_CONTRACT, f"{layout.broken}/gold", run_id)
        updated = [c for c in gold.columns if c not in (*GOLD_CONTRACT.key, "created_at")]
        gold_rows = upsert_gold(gold, layout.gold, updated=updated)
        refresh_daily_summary(current, layout.summary, run_ts.date(), run_ts)
        counters["records_loaded"] = changes["new"] + changes["version"] + gold_rows
        log_run(_record(spark, run_id, name, run_ts, "success", counters, started), layout.runs)
        return counters | changes
    except Exception as error:
        failed = _record(spark, run_id, name, run_ts, "failed", counters, started, str(error))
        log_run(failed, layout.runs)
        raise


def rejected(spark: SparkSession, layout: Layout, run_ts: datetime) -> DataFrame:
    """The rows a run rejected, with their reasons."""
    run_id = run_ts.strftime("%Y%m%d%H%M%S")
    return read_quarantine(spark, f"{layout.validated}/run_id={run_id}")
