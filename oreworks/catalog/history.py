"""Type-2 history, Gold upsert, summary refresh and incremental queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from oreworks.catalog.gold import _SUMMARY_SQL
from oreworks.catalog.registry import as_long, query, rounded
from oreworks.catalog.sqltext import silver_sql, versions_sql
from oreworks.config import RowRules
from oreworks.operators.gold import gold_by_category
from oreworks.operators.history import as_of_versions, latest_per_key, scd2_changes
from oreworks.plans import views
from oreworks.plans.adapters import (
    PART_CAPS,
    PRICE_THRESHOLD,
    SNAPSHOT_DAYS,
    flagged_snapshot,
    market_snapshot,
    silver_snapshot,
    table,
)
from oreworks.plans.batch_run import Layout, run_batch
from oreworks.plans.gold_store import append_gold, refresh_daily_summary, upsert_gold
from oreworks.sinks.files import shared_dir
from oreworks.sinks.silver_store import merge_batch, read_current, read_versions, rebucket
from oreworks.sinks.tables import write_json, write_table
from oreworks.sources.landing import read_json_lines
from oreworks.streaming.incremental import incremental_silver

RULES = RowRules(not_null=("id", "symbol", "name", "current_price"))
_VERSION_COLUMNS = (
    "coin_id",
    "symbol",
    "name",
    "current_price",
    "market_cap",
    "total_volume",
    "price_change_percentage_24h",
    "market_cap_category",
    "is_price_anomaly",
    "is_volume_spike",
    "valid_from",
    "valid_to",
    "is_current",
)
_CHANGE = "price_change_percentage_24h"
_NARROW = (
    "coin_id",
    "symbol",
    "name",
    "current_price",
    "market_cap",
    "total_volume",
    _CHANGE,
    "market_cap_category",
    "last_updated",
    "extracted_at",
    "price_volatility_24h",
)


def _history(spark, sf_dir, columns=_NARROW):
    """The Silver history after all snapshot days, one merge per day."""
    root = shared_dir(spark, "history")
    for day in SNAPSHOT_DAYS:
        merge_batch(spark, root, flagged_snapshot(spark, sf_dir, day, columns), day)
    return root


@query(
    "scd2_merge",
    versions_sql(f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions", *SNAPSHOT_DAYS),
)
def _scd2_merge(spark, sf_dir):
    return read_versions(spark, _history(spark, sf_dir)).select(*_VERSION_COLUMNS)


# Keys of one part number in fifty.
_FEW = "CAST(coin_id AS BIGINT) % 50 = 0"


@query(
    "scd2_few_keys",
    versions_sql(
        f"""SELECT {', '.join(c for c in _VERSION_COLUMNS if c not in ('valid_to', 'is_current'))},
          CASE WHEN {_FEW} THEN valid_to END AS valid_to,
          NOT ({_FEW}) OR is_current AS is_current
        FROM versions WHERE {_FEW} OR valid_from = TIMESTAMP '{SNAPSHOT_DAYS[0]}'""",
        SNAPSHOT_DAYS[0],
        SNAPSHOT_DAYS[-1],
    ),
)
def _scd2_few_keys(spark, sf_dir):
    """A second batch of few keys leaves the buckets of the others alone."""
    root = shared_dir(spark, "few-keys")
    first, last = SNAPSHOT_DAYS[0], SNAPSHOT_DAYS[-1]
    merge_batch(spark, root, flagged_snapshot(spark, sf_dir, first, _NARROW), first, buckets=64)
    few = flagged_snapshot(spark, sf_dir, last, _NARROW).filter(_FEW)
    merge_batch(spark, root, few, last)
    return read_versions(spark, root).select(*_VERSION_COLUMNS)


@query(
    "silver_rebucketed",
    versions_sql(f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions", *SNAPSHOT_DAYS),
)
def _silver_rebucketed(spark, sf_dir):
    """The store goes on in more buckets after two of three runs."""
    root = shared_dir(spark, "rebucketed")
    for day in SNAPSHOT_DAYS:
        if day == SNAPSHOT_DAYS[-1]:
            rebucket(spark, root, 12)
        merge_batch(spark, root, flagged_snapshot(spark, sf_dir, day, _NARROW), day)
    return read_versions(spark, root).select(*_VERSION_COLUMNS)


@query(
    "silver_current",
    versions_sql(
        f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions WHERE is_current", *SNAPSHOT_DAYS
    ),
)
def _silver_current(spark, sf_dir):
    return read_current(spark, _history(spark, sf_dir)).select(*_VERSION_COLUMNS)


@query(
    "silver_at_time",
    versions_sql(
        f"""SELECT {', '.join(_VERSION_COLUMNS)} FROM versions
        WHERE valid_from <= TIMESTAMP '1998-07-15'
          AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-07-15')""",
        *SNAPSHOT_DAYS,
    ),
)
def _silver_at_time(spark, sf_dir):
    versions = read_versions(spark, _history(spark, sf_dir))
    return as_of_versions(versions, datetime(1998, 7, 15)).select(*_VERSION_COLUMNS)


@query(
    "price_history",
    versions_sql(
        """SELECT coin_id, symbol, name, current_price, market_cap, valid_from, valid_to,
          CAST(date_diff('day', valid_from, coalesce(valid_to, TIMESTAMP '1998-09-01'))
            AS INTEGER) AS days_at_price
        FROM versions""",
        *SNAPSHOT_DAYS,
    ),
)
def _price_history(spark, sf_dir):
    versions = read_versions(spark, _history(spark, sf_dir))
    return views.price_history(versions, datetime(1998, 9, 1))


def _last_two(spark, sf_dir):
    """The open versions of one day and the batch of the next."""
    first, second = _TWO_DAYS
    before = scd2_changes(None, silver_snapshot(spark, sf_dir, first).select(*_NARROW), first)
    batch = silver_snapshot(spark, sf_dir, second).select(*_NARROW)
    return before.drop("change"), latest_per_key(batch, ["coin_id"]), second


_TWO_DAYS = (SNAPSHOT_DAYS[0], SNAPSHOT_DAYS[-1])
_OPENED = f"WHERE valid_from = TIMESTAMP '{_TWO_DAYS[1]}'"


@query(
    "scd2_new_keys",
    versions_sql(
        f"""SELECT coin_id, current_price, market_cap, valid_from FROM versions
        {_OPENED} AND before_as_of IS NULL""",
        *_TWO_DAYS,
    ),
)
def _scd2_new_keys(spark, sf_dir):
    changes = scd2_changes(*_last_two(spark, sf_dir))
    added = changes.filter(F.col("change") == "new")
    return added.select("coin_id", "current_price", "market_cap", "valid_from")


@query(
    "scd2_new_versions",
    versions_sql(
        f"""SELECT coin_id, current_price, market_cap, valid_from, 'version' AS change
        FROM versions {_OPENED} AND before_as_of IS NOT NULL
        UNION ALL
        SELECT coin_id, current_price, market_cap, valid_from, 'closed' AS change
        FROM versions WHERE valid_to IS NOT NULL""",
        *_TWO_DAYS,
    ),
)
def _scd2_new_versions(spark, sf_dir):
    changes = scd2_changes(*_last_two(spark, sf_dir))
    changed = changes.filter(F.col("change").isin("version", "closed"))
    return changed.select("coin_id", "current_price", "market_cap", "valid_from", "change")


@query(
    "latest_per_user",
    """SELECT user_id, event_id, ts, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth
         FROM events) WHERE nth = 1""",
)
def _latest_per_user(spark, sf_dir):
    """The step that makes a batch unique per key, on events."""
    events = table(spark, sf_dir, "events")
    events = events.select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


@query(
    "silver_append",
    silver_sql(
        """SELECT coin_id, symbol, name, current_price, market_cap, market_cap_rank, total_volume,
          price_change_percentage_24h, updated_at,
          'run_' || strftime(as_of, '%Y%m%d') AS run_id, true AS is_current
        FROM silver""",
        *_TWO_DAYS,
    ),
)
def _silver_append(spark, sf_dir):
    path = shared_dir(spark, "silver-append")
    for day in _TWO_DAYS:
        rows = silver_snapshot(spark, sf_dir, day, ranked=True).select(
            "coin_id",
            "symbol",
            "name",
            "current_price",
            "market_cap",
            "market_cap_rank",
            "total_volume",
            _CHANGE,
            "updated_at",
            F.lit(day.strftime("run_%Y%m%d")).alias("run_id"),
            F.lit(True).alias("is_current"),
        )
        write_table(rows, path, "append")
    return spark.read.parquet(path)


_GOLD_SQL = """SELECT CAST(as_of AS DATE) AS metric_date, market_cap_category,
  CAST(count(*) AS BIGINT) AS num_coins,
  CAST(sum(market_cap) AS BIGINT) AS total_market_cap,
  CAST(sum(total_volume) AS BIGINT) AS total_volume_24h,
  round(avg(current_price), 6) AS avg_price,
  max(market_cap) AS max_market_cap, min(market_cap) AS min_market_cap
FROM silver GROUP BY 1, 2"""


def _gold_columns(gold):
    gold = gold.select(
        "metric_date",
        "market_cap_category",
        "num_coins",
        "total_market_cap",
        "total_volume_24h",
        "avg_price",
        "max_market_cap",
        "min_market_cap",
    )
    return rounded(as_long(gold, "total_market_cap", "total_volume_24h"), 6, "avg_price")


@query("gold_append", silver_sql(_GOLD_SQL, *_TWO_DAYS))
def _gold_append(spark, sf_dir):
    path = shared_dir(spark, "gold-append")
    for day in _TWO_DAYS:
        append_gold(gold_by_category(silver_snapshot(spark, sf_dir, day), day), path)
    return _gold_columns(spark.read.parquet(path))


@query("gold_upsert", silver_sql(_GOLD_SQL, *_TWO_DAYS))
def _gold_upsert(spark, sf_dir):
    """The second day is loaded twice, first with the figures of the first day."""
    path = shared_dir(spark, "gold")
    first, second = (
        gold_by_category(silver_snapshot(spark, sf_dir, day), day) for day in _TWO_DAYS
    )
    upsert_gold(first, path)
    stale = first.withColumn("metric_date", F.lit(_TWO_DAYS[1].date()))
    upsert_gold(stale, path)
    upsert_gold(second, path)
    return _gold_columns(spark.read.parquet(path))


@query(
    "refresh_daily_summary",
    versions_sql(
        f"{_SUMMARY_SQL} FROM versions WHERE is_current GROUP BY 1, 2", *SNAPSHOT_DAYS
    ),
)
def _refresh_daily_summary(spark, sf_dir):
    """One refresh per day over the final state; days without current rows stay absent."""
    current = read_current(spark, _history(spark, sf_dir))
    path = shared_dir(spark, "summary")
    for day in SNAPSHOT_DAYS:
        refresh_daily_summary(current, path, day.date(), day)
    summary = spark.read.parquet(path).drop("created_at")
    summary = as_long(summary, "total_market_cap", "total_volume")
    return rounded(summary, 6, "avg_price", "avg_price_change_24h", "avg_volatility")


@query(
    "incremental_silver",
    versions_sql(f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions", *_TWO_DAYS),
)
def _incremental_silver(spark, sf_dir):
    """Two landings; the stream is started after each and takes only the new files."""
    return _streamed(spark, sf_dir, *[(day,) for day in _TWO_DAYS])


@query(
    "incremental_at_once",
    versions_sql(f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions", *SNAPSHOT_DAYS),
)
def _incremental_at_once(spark, sf_dir):
    """All snapshots wait in one micro-batch and still leave a version each."""
    return _streamed(spark, sf_dir, SNAPSHOT_DAYS)


@query(
    "incremental_late",
    versions_sql(f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions", *SNAPSHOT_DAYS),
)
def _incremental_late(spark, sf_dir):
    """The middle snapshot lands after the last one and is merged at its place in time."""
    first, late, last = SNAPSHOT_DAYS
    return _streamed(spark, sf_dir, (first, last), (late,))


@query(
    "incremental_same_time",
    versions_sql(f"SELECT {', '.join(_VERSION_COLUMNS)} FROM versions", *_TWO_DAYS),
)
def _incremental_same_time(spark, sf_dir):
    """A snapshot lands in two parts, and older records of its first part come with the second."""
    first, last = _TWO_DAYS
    even = F.col("id").cast("bigint") % 2 == 0
    rows = market_snapshot(spark, sf_dir, last)
    older = {"current_price": F.col("current_price") * 2, "last_updated": F.lit("1990-01-01T00:00:00")}
    second = rows.filter(~even).unionByName(rows.filter(even).withColumns(older))
    return _streamed(spark, sf_dir, (market_snapshot(spark, sf_dir, first),), (rows.filter(even),), (second,))


def _streamed(spark, sf_dir, *landings):
    """The history of the stream, started after each landing of some snapshots (or their days)."""
    base = shared_dir(spark, "incremental")
    for group in landings:
        for given in group:
            rows = market_snapshot(spark, sf_dir, given) if isinstance(given, datetime) else given
            write_json(rows, f"{base}/landing", "append")
        incremental_silver(
            spark,
            f"{base}/landing",
            f"{base}/silver",
            f"{base}/checkpoint",
            RULES,
            PRICE_THRESHOLD,
            PART_CAPS,
        )
    return read_versions(spark, f"{base}/silver").select(*_VERSION_COLUMNS)


@query(
    "batch_to_gold",
    versions_sql(
        """SELECT CAST(run_at AS DATE) AS metric_date, market_cap_category,
          CAST(count(*) AS BIGINT) AS num_coins,
          CAST(sum(market_cap) AS BIGINT) AS total_market_cap,
          CAST(sum(total_volume) AS BIGINT) AS total_volume_24h,
          round(avg(current_price), 6) AS avg_price,
          max(market_cap) AS max_market_cap, min(market_cap) AS min_market_cap
        FROM versions JOIN (SELECT as_of AS run_at FROM days) runs
          ON valid_from <= run_at AND (valid_to IS NULL OR valid_to > run_at)
        GROUP BY 1, 2""",
        *_TWO_DAYS,
    ),
)
def _batch_to_gold(spark, sf_dir):
    """The whole way for two batches: land, validate, enrich, flag, merge, aggregate, log."""
    base = shared_dir(spark, "batches")
    layout = Layout(f"{base}/tables")
    for day in _TWO_DAYS:
        landed = f"{base}/landing/{day:%Y%m%d}"
        write_json(market_snapshot(spark, sf_dir, day), landed)
        records = read_json_lines(spark, landed)
        run_batch(spark, records, layout, day, RULES, PRICE_THRESHOLD, PART_CAPS)
    return _gold_columns(spark.read.parquet(layout.gold))
