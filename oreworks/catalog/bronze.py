"""Landing and Bronze queries. Files are written from the tables first, then read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from oreworks.catalog.registry import query
from oreworks.operators.silver import dedup_rows
from oreworks.plans.adapters import bronze_events, event_records, table
from oreworks.sinks import bronze_store as store
from oreworks.sinks.files import shared_dir
from oreworks.sinks.tables import write_json
from oreworks.sources import landing
from oreworks.sources.json_arrays import read_split_arrays

LOADED_AT = datetime(2024, 2, 1, 12, 30, 45)
PAGE_SIZE = 100
SOURCE = "parts_feed"
# A page whose sizes add up to more than this was cut off in transfer.
DAMAGED_ABOVE = 2700


def _part_records(spark, sf_dir):
    """Parts as feed records; the market cap has a fraction on purpose."""
    return table(spark, sf_dir, "part").select(
        (1 + F.floor(F.col("p_partkey") / PAGE_SIZE)).cast("int").alias("page"),
        "p_partkey",
        "p_size",
        F.to_json(
            F.struct(
                F.col("p_partkey").cast("string").alias("id"),
                F.col("p_brand").alias("symbol"),
                F.col("p_name").alias("name"),
                (F.col("p_retailprice") / 100).alias("current_price"),
                F.col("p_retailprice").alias("market_cap"),
                F.col("p_size").alias("total_volume"),
                F.lit("2024-02-01T00:00:00").alias("extracted_at"),
                F.lit(SOURCE).alias("source"),
            )
        ).alias("record"),
    )


def _write_pages(spark, sf_dir, damage=False):
    """One JSON array file per page of 100 records, written by all tasks at once."""
    listed = F.array_join(F.collect_list("record"), ",\n")
    pages = (
        _part_records(spark, sf_dir)
        .repartition(spark.sparkContext.defaultParallelism, "page")
        .groupBy("page")
        .agg(F.concat(F.lit("["), listed, F.lit("]")).alias("text"), F.sum("p_size").alias("size"))
    )
    cut = F.substring("text", F.lit(1), F.length("text") - 40)
    text = F.when(F.col("size") > DAMAGED_ABOVE, cut).otherwise(F.col("text"))
    path = shared_dir(spark, "pages")
    pages.select("page", (text if damage else F.col("text")).alias("value")).write.partitionBy(
        "page"
    ).text(path)
    return path


_PART_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS symbol, p_name AS name,
  p_retailprice / 100 AS current_price, CAST(floor(p_retailprice) AS BIGINT) AS market_cap,
  CAST(p_size AS BIGINT) AS total_volume"""
_PART_COLUMNS = ("id", "symbol", "name", "current_price", "market_cap", "total_volume")


@query(
    "read_json_schema",
    f"""{_PART_SQL}, CAST(NULL AS DOUBLE) AS high_24h, '{SOURCE}' AS source,
      p_retailprice <> floor(p_retailprice) AS fraction_lost FROM part""",
)
def _read_json_schema(spark, sf_dir):
    records = landing.read_json_arrays(spark, _write_pages(spark, sf_dir))
    return records.select(*_PART_COLUMNS, "high_24h", "source", "fraction_lost")


# Parts above this size have a damaged record; every fifth size has braces and a quote in its name.
BROKEN_ABOVE = 45
_BROKEN_SQL = """'{"id":"' || p_partkey || '","total_volume":}'"""


@query(
    "read_json_split",
    f"""SELECT CASE WHEN p_size <= {BROKEN_ABOVE} THEN CAST(p_partkey AS VARCHAR) END AS id,
      CASE WHEN p_size <= {BROKEN_ABOVE} THEN
        CASE WHEN p_size % 5 = 0 THEN '}},{{"' || p_name || '}}' ELSE p_name END END AS name,
      CASE WHEN p_size <= {BROKEN_ABOVE} THEN CAST(floor(p_retailprice) AS BIGINT) END AS market_cap,
      CASE WHEN p_size > {BROKEN_ABOVE} THEN {_BROKEN_SQL} END AS corrupt_text FROM part""",
)
def _read_json_split(spark, sf_dir):
    """Array files are read by byte ranges; damaged records come with their text."""
    odd_name = F.concat(F.lit('},{"'), F.col("p_name"), F.lit("}"))
    record = F.to_json(
        F.struct(
            F.col("p_partkey").cast("string").alias("id"),
            F.when(F.col("p_size") % 5 == 0, odd_name).otherwise(F.col("p_name")).alias("name"),
            F.col("p_retailprice").alias("market_cap"),
        )
    )
    broken = F.concat(F.lit('{"id":"'), F.col("p_partkey"), F.lit('","total_volume":}'))
    text = F.when(F.col("p_size") > BROKEN_ABOVE, broken).otherwise(record)
    page = F.floor(F.col("p_partkey") / PAGE_SIZE)
    listed = F.array_join(F.collect_list("text"), ",\n")
    arrays = table(spark, sf_dir, "part").select(page.alias("page"), text.alias("text"))
    arrays = arrays.groupBy("page").agg(F.concat(F.lit("["), listed, F.lit("]")).alias("value"))
    path = shared_dir(spark, "arrays")
    arrays.select("value").write.text(path)
    return read_split_arrays(spark, path).select("id", "name", "market_cap", "corrupt_text")


@query(
    "bronze_audit",
    f"""{_PART_SQL}, TIMESTAMP '{LOADED_AT}' AS bronze_loaded_at,
      '20240201123045' AS bronze_batch_id FROM part""",
)
def _bronze_audit(spark, sf_dir):
    path = shared_dir(spark, "lines")
    _part_records(spark, sf_dir).select("record").write.text(path)
    audited = landing.add_load_audit(landing.read_json_lines(spark, path), LOADED_AT)
    return audited.select(*_PART_COLUMNS, "bronze_loaded_at", "bronze_batch_id")


_PAGE_SQL = f"CAST(1 + floor(p_partkey / {PAGE_SIZE}) AS INTEGER)"


@query(
    "paged_ingest",
    f"""{_PART_SQL}, {_PAGE_SQL} AS extraction_page FROM part
      WHERE {_PAGE_SQL} IN (
        SELECT {_PAGE_SQL} FROM part GROUP BY 1 HAVING sum(p_size) <= {DAMAGED_ABOVE})""",
)
def _paged_ingest(spark, sf_dir):
    """Damaged pages are missing as a whole, all others are complete."""
    records = landing.read_pages(spark, _write_pages(spark, sf_dir, damage=True))
    return records.select(*_PART_COLUMNS, "extraction_page")


@query(
    "failed_pages",
    f"""SELECT {_PAGE_SQL} AS extraction_page FROM part GROUP BY 1
      HAVING sum(p_size) > {DAMAGED_ABOVE}""",
)
def _failed_pages(spark, sf_dir):
    return landing.failed_pages(spark, _write_pages(spark, sf_dir, damage=True)).select(
        "extraction_page"
    )


@query(
    "extraction_tags",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, '2024-02-01T12:30:45' AS extracted_at,
      '{SOURCE}' AS source, {_PAGE_SQL} AS extraction_page FROM part""",
)
def _extraction_tags(spark, sf_dir):
    records = landing.read_pages(spark, _write_pages(spark, sf_dir))
    tagged = landing.tag_extraction(records, LOADED_AT, SOURCE)
    return tagged.select("id", "extracted_at", "source", "extraction_page")


@query(
    "trending_payload",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_size AS BIGINT) AS score,
      '2024-02-01T12:30:45' AS extracted_at, '{SOURCE}' AS source FROM part""",
)
def _trending_payload(spark, sf_dir):
    """One object per page, its list holding the entries."""
    entry = F.struct(
        F.struct(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_size").alias("score"),
        ).alias("item")
    )
    page = (1 + F.floor(F.col("p_partkey") / PAGE_SIZE)).cast("int")
    path = shared_dir(spark, "trending")
    objects = table(spark, sf_dir, "part").groupBy(page.alias("page"))
    objects = objects.agg(F.collect_list(entry).alias("coins"))
    objects.select(F.to_json(F.struct("page", "coins"))).write.text(path)
    read = landing.read_objects(spark, path, LOADED_AT, SOURCE)
    entries = landing.explode_list(read, "payload", "$.coins")
    return landing.project_paths(
        entries,
        "item",
        {
            "id": ("$.item.id", "string"),
            "name": ("$.item.name", "string"),
            "score": ("$.item.score", "bigint"),
        },
        keep=("extracted_at", "source"),
    )


@query(
    "flatten_struct",
    """SELECT event_id, event_type AS "detail.kind", value AS "detail.measure.value",
         CAST(json_extract(props, '$.k') AS BIGINT) AS "detail.measure.props.k",
         event_type || ',' || CAST(user_id AS VARCHAR) AS labels
       FROM events""",
)
def _flatten_struct(spark, sf_dir):
    props = F.from_json("props", "struct<k:bigint>").alias("props")
    measure = F.struct("value", props).alias("measure")
    labels = F.array("event_type", F.col("user_id").cast("string")).alias("labels")
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("event_type").alias("kind"), measure).alias("detail"), labels
    )
    flat = landing.flatten_structs(nested)
    return flat.withColumn("labels", F.array_join("labels", ","))


@query("infer_schema", "SELECT event_id, event_type, value, props FROM events")
def _infer_schema(spark, sf_dir):
    path = shared_dir(spark, "inferred")
    event_records(spark, sf_dir).select("record").write.text(path)
    return landing.infer_records(spark, path).select("event_id", "event_type", "value", "props")


@query("write_json_roundtrip", "SELECT event_id, user_id, event_type, value, props FROM events")
def _write_json_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "json")
    events = table(spark, sf_dir, "events")
    events = events.select("event_id", "user_id", "event_type", "value", "props")
    write_json(events, path)
    return spark.read.schema(events.schema).json(path)


_PATHS = {
    "event_id": ("$.event_id", "bigint"),
    "event_type": ("$.event_type", "string"),
    "value": ("$.value", "double"),
}


@query(
    "json_path_project",
    """SELECT CAST(event_id AS VARCHAR) AS id, event_type, value,
         TRY_CAST(event_type AS BIGINT) AS type_number FROM events""",
)
def _json_path_project(spark, sf_dir):
    paths = {"event_type": ("$.event_type", "string"), "value": ("$.value", "double")}
    paths["type_number"] = ("$.event_type", "bigint")  # fails the cast: null
    return landing.project_paths(bronze_events(spark, sf_dir), "payload", paths, keep=("id",))


@query(
    "bronze_unprocessed",
    """SELECT CAST(event_id AS VARCHAR) AS id, event_id, event_type, value, ts AS created_at
       FROM events WHERE event_id % 2 <> 0""",
)
def _bronze_unprocessed(spark, sf_dir):
    rows = store.unprocessed(bronze_events(spark, sf_dir), None, newest_first=True)
    return landing.project_paths(rows, "payload", _PATHS, keep=("id", "created_at"))


@query(
    "select_by_ids",
    """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, value
       FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""",
)
def _select_by_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").filter("c_acctbal > 5000")
    ids = ids.select(F.col("c_custkey").cast("string").alias("user_id"))
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        "value",
    )
    return landing.select_ids(events, ids, "user_id")


def _landed(spark, sf_dir, damage=False):
    """All events in a Bronze table; with ``damage`` error events arrive cut off."""
    records = event_records(spark, sf_dir)
    if damage:
        is_error = F.col("record").contains('"event_type":"error"')
        cut = F.substring("record", F.lit(1), F.length("record") - 3)
        records = records.withColumn(
            "record", F.when(is_error, cut).otherwise(F.col("record"))
        )
    path = shared_dir(spark, "bronze")
    counts = store.land_payloads(store.as_bronze(records, "events"), path)
    return path, counts


@query(
    "bronze_variant_append",
    """SELECT 'accepted' AS kept_as, 'run_' || strftime(ts, '%Y%m%d') AS run_id,
         event_id, event_type, value FROM events WHERE event_type <> 'error'
       UNION ALL
       SELECT 'rejected', 'run_' || strftime(ts, '%Y%m%d'), event_id, NULL, NULL
       FROM events WHERE event_type = 'error'""",
)
def _bronze_variant_append(spark, sf_dir):
    path, _ = _landed(spark, sf_dir, damage=True)
    accepted = landing.project_paths(
        store.read_bronze(spark, path), "payload", _PATHS, keep=("run_id",)
    )
    text_id = F.regexp_extract("rejected_text", r'"event_id":(\d+)', 1)
    rejected = store.read_rejected(spark, path).select(
        F.lit("rejected").alias("kept_as"),
        "run_id",
        text_id.try_cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("double").alias("value"),
    )
    kept = accepted.withColumn("kept_as", F.lit("accepted"))
    return kept.unionByName(rejected).select(
        "kept_as", "run_id", "event_id", "event_type", "value"
    )


_DONE = ("run_20240101", "run_20240102", "run_20240115")


@query(
    "mark_processed",
    f"""SELECT event_id, event_type, value, 'run_' || strftime(ts, '%Y%m%d') AS run_id
       FROM events
       WHERE event_id % 2 <> 0 AND 'run_' || strftime(ts, '%Y%m%d') NOT IN {_DONE}""",
)
def _mark_processed(spark, sf_dir):
    path, _ = _landed(spark, sf_dir)
    ledger = shared_dir(spark, "ledger")
    for run_id in _DONE:
        store.mark_processed(spark, ledger, run_id, LOADED_AT)
    rows = store.unprocessed(store.read_bronze(spark, path), spark.read.parquet(ledger))
    return landing.project_paths(rows, "payload", _PATHS, keep=("run_id",))


@query(
    "archive_bronze",
    """SELECT CASE WHEN CAST(ts AS DATE) < DATE '2024-01-17' THEN 'archive' ELSE 'bronze' END
         AS place, CAST(ts AS DATE) AS ingest_date, CAST(count(*) AS BIGINT) AS record_count
       FROM events GROUP BY ALL""",
)
def _archive_bronze(spark, sf_dir):
    path, _ = _landed(spark, sf_dir)
    archive = shared_dir(spark, "archive")
    store.archive_bronze(spark, path, archive, datetime(2024, 1, 31), days=14)
    both = None
    for place, where in (("archive", archive), ("bronze", path)):
        rows = store.read_bronze(spark, where).select(F.lit(place).alias("place"), "ingest_date")
        both = rows if both is None else both.unionByName(rows)
    return both.groupBy("place", "ingest_date").agg(F.count("*").alias("record_count"))


@query(
    "bronze_extraction_stats",
    """SELECT 'run_' || strftime(ts, '%Y%m%d') AS run_id, 'events' AS source_system,
         CAST(count(*) AS BIGINT) AS record_count,
         CAST(count(*) FILTER (event_id % 2 = 0) AS BIGINT) AS processed_count,
         min(ts) AS first_extracted_at, max(ts) AS last_extracted_at
       FROM events GROUP BY 1""",
)
def _bronze_extraction_stats(spark, sf_dir):
    return store.extraction_stats(bronze_events(spark, sf_dir))


@query(
    "bronze_dedup",
    "SELECT DISTINCT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def _bronze_dedup(spark, sf_dir):
    """Payloads cannot be compared as such: project typed columns, then take distinct rows."""
    props = F.try_variant_get(F.col("payload"), "$.props", "string")
    rows = bronze_events(spark, sf_dir).select(
        F.try_variant_get(F.col("payload"), "$.event_type", "string").alias("event_type"),
        F.try_variant_get(F.try_parse_json(props), "$.k", "bigint").alias("k"),
    )
    return dedup_rows(rows)


