"""Landing, Bronze table, sinks."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oreworks.schemas import BRONZE_SCHEMA
from oreworks.sinks import bronze_store as store
from oreworks.sinks.files import child_names, shared_dir, total_bytes
from oreworks.sinks.run_log import log_run, run_record
from oreworks.sinks.tables import (
    compact_zorder,
    drop_partition,
    read_table,
    replace_partitions,
    with_z_key,
    write_json,
    write_table,
    zorder_bits,
)
from oreworks.sources import landing

AT = datetime(2024, 2, 1, 12, 30, 45)


def put(folder, name, text):
    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def record(i, **more):
    return {"id": f"c{i}", "symbol": f"s{i}", "name": f"n{i}", "current_price": 1.5 * i} | more


def test_json_arrays_keep_fractions_and_large_numbers(spark, folder):
    rows = [
        record(1, market_cap=850000000000.5, total_volume=9007199254740993, source="x"),
        record(2, market_cap=7, total_volume=None, market_cap_rank=3, extracted_at="t"),
    ]
    put(folder, "a_1.json", json.dumps(rows, indent=2))
    put(folder, "a_2.json", json.dumps([record(3)]))
    df = landing.read_json_arrays(spark, f"{folder}/a_*.json")
    assert df.columns == [*BRONZE_SCHEMA.names, "fraction_lost"]
    assert [f.dataType for f in df.schema][:-1] == [f.dataType for f in BRONZE_SCHEMA]
    found = {r.id: r for r in df.collect()}
    assert found["c1"].market_cap == 850000000000 and found["c1"].fraction_lost is True
    assert found["c1"].total_volume == 9007199254740993  # more digits than a double holds
    assert found["c2"].market_cap == 7 and found["c2"].fraction_lost is False
    assert found["c2"].market_cap_rank == 3 and found["c3"].current_price == 4.5


def test_load_audit(spark):
    row = landing.add_load_audit(spark.range(1), AT).first()
    assert row.bronze_loaded_at == AT and row.bronze_batch_id == "20240201123045"


def test_a_damaged_page_drops_out_whole(spark, folder):
    for page in (1, 2, 3):
        text = json.dumps([record(10 * page + i) for i in range(2)])
        put(folder, f"page_{page}.json", text[:-25] if page == 2 else text)
    pages = landing.tag_extraction(landing.read_pages(spark, folder), AT, "feed")
    rows = sorted((r.id, r.extraction_page, r.extracted_at, r.source) for r in pages.collect())
    tags = ("2024-02-01T12:30:45", "feed")
    assert rows == [("c10", 1, *tags), ("c11", 1, *tags), ("c30", 3, *tags), ("c31", 3, *tags)]
    assert [r.extraction_page for r in landing.failed_pages(spark, folder).collect()] == [2]


def test_object_payload_and_list(spark, folder):
    put(folder, "t.json", json.dumps({"coins": [{"item": record(1)}, {"item": record(2)}]}))
    objects = landing.read_objects(spark, folder, AT, "feed")
    items = landing.explode_list(objects, "payload", "$.coins")
    paths = {"id": ("$.item.id", "string"), "price": ("$.item.current_price", "double")}
    rows = landing.project_paths(items, "item", paths, keep=("source",)).orderBy("id").collect()
    assert [(r.id, r.price, r.source) for r in rows] == [("c1", 1.5, "feed"), ("c2", 3.0, "feed")]


def test_flatten_leaves_lists(spark):
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("x"), F.struct(F.lit("q").alias("y.z")).alias("deep")).alias("a"),
        F.array(F.lit(1)).alias("l"),
    )
    flat = landing.flatten_structs(df)
    assert flat.columns == ["a.x", "a.deep.y.z", "l"]
    assert tuple(flat.first()) == (1, "q", [1])


def test_inferred_records(spark, folder):
    put(folder, "r.json", json.dumps(record(1)) + "\n" + json.dumps(record(2)))
    df = landing.infer_records(spark, folder)
    assert dict(df.dtypes)["current_price"] == "double" and df.count() == 2


def test_ids_and_views(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "id string, v int")
    ids = spark.createDataFrame([("a",), ("zz",), (None,)], "id string")
    assert sorted(r.v for r in landing.select_ids(df, ids, "id").collect()) == [1, 3]
    landing.register(df, "landed")
    assert spark.sql("SELECT count(*) FROM landed").first()[0] == 4


def raw(spark):
    rows = [
        ("r1", datetime(2023, 10, 1, 23), json.dumps(record(1))),
        ("r1", datetime(2024, 1, 1, 1), json.dumps(record(2))),
        ("r2", datetime(2024, 1, 2, 1), json.dumps(record(3))),
        ("r2", datetime(2024, 1, 2, 2), '{"id": "cut'),
    ]
    return spark.createDataFrame(rows, "run_id string, extracted_at timestamp_ntz, record string")


def test_bronze_landing_ledger_archive(spark, folder):
    path, ledger, archive = (f"{folder}/{n}" for n in ("bronze", "ledger", "archive"))
    counts = store.land_payloads(store.as_bronze(raw(spark), "feed"), path)
    assert counts == {"accepted": 3, "rejected": 1}
    bronze = store.read_bronze(spark, path)
    assert bronze.select("id").distinct().count() == 3
    assert store.read_rejected(spark, path).first().rejected_text == '{"id": "cut'
    symbols = landing.project_paths(bronze, "payload", {"s": ("$.symbol", "string")})
    assert sorted(r.s for r in symbols.collect()) == ["s1", "s2", "s3"]

    store.mark_processed(spark, ledger, "r1", AT)
    store.mark_processed(spark, ledger, "r1", AT)
    left = store.unprocessed(bronze, spark.read.parquet(ledger))
    assert [r.run_id for r in left.collect()] == ["r2"]
    newest = store.unprocessed(bronze, None, newest_first=True)
    assert [r.run_id for r in newest.collect()] == ["r2", "r1", "r1"]

    stats = {r.run_id: r for r in store.extraction_stats(bronze).collect()}
    assert stats["r1"].record_count == 2 and stats["r1"].processed_count == 0
    assert stats["r1"].first_extracted_at == datetime(2023, 10, 1, 23)

    assert store.archive_bronze(spark, path, archive, datetime(2024, 1, 3, 12), 90) == 1
    assert store.read_bronze(spark, path).count() == 2
    assert store.read_bronze(spark, archive).count() == 1
    assert store.archive_bronze(spark, path, archive, datetime(2024, 1, 3, 12), 90) == 0
    assert store.read_bronze(spark, archive).count() == 1
    # A late row of an archived day joins the others there.
    late = raw(spark).filter("run_id = 'r1' AND extracted_at < '2024-01-01'")
    store.land_payloads(store.as_bronze(late, "feed"), path)
    assert store.archive_bronze(spark, path, archive, datetime(2024, 1, 3, 12), 90) == 1
    assert store.read_bronze(spark, archive).count() == 2
    assert store.read_bronze(spark, path).count() == 2


def test_bronze_reads_only_the_wanted_days(spark, folder):
    store.land_payloads(store.as_bronze(raw(spark), "feed"), folder)
    day = store.read_bronze(spark, folder).filter("ingest_date = DATE'2024-01-01'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert day.count() == 1


def test_write_modes(spark, folder):
    first = spark.createDataFrame([(1, "x")], "a int, b string")
    write_table(first, folder, "overwrite")
    write_table(spark.createDataFrame([(2, 0.5)], "a int, c double"), folder, "append")
    rows = {r.a: (r.b, r.c) for r in read_table(spark, folder).collect()}
    assert rows == {1: ("x", None), 2: (None, 0.5)}
    write_table(spark.createDataFrame([(3,)], "z int"), folder, "overwrite")
    assert read_table(spark, folder).columns == ["z"]


def test_json_keeps_null_fields(spark, folder):
    df = spark.createDataFrame([(1, None), (2, "é")], "a int, b string")
    write_json(df, folder)
    assert sorted(r.value for r in spark.read.text(folder).collect()) == [
        '{"a":1,"b":null}',
        '{"a":2,"b":"é"}',
    ]


def test_replace_partitions_leaves_others(spark, folder):
    replace_partitions(spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string"), folder, "p")
    table = spark.read.parquet(folder)
    # The rows may come from the table itself.
    assert replace_partitions(table.filter("p = 'x'").withColumn("v", F.col("v") + 9), folder, "p") == 1
    assert {r.p: r.v for r in spark.read.parquet(folder).collect()} == {"x": 10, "y": 2}
    assert replace_partitions(table.filter("p = 'none'"), folder, "p") == 0
    assert drop_partition(spark, folder, "p", "x") and not drop_partition(spark, folder, "p", "x")
    assert [r.p for r in spark.read.parquet(folder).collect()] == ["y"]


def test_z_key_orders_cells(spark):
    grid = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    keyed = with_z_key(grid, ["x", "y"], bits=3).collect()
    spread = lambda n, bit: sum(((n >> i) & 1) << (2 * i + bit) for i in range(3))
    assert {(r.x, r.y): r["_z"] for r in keyed} == {
        (x, y): spread(x, 0) | spread(y, 1) for x in range(8) for y in range(8)
    }


def test_z_key_of_texts_with_a_long_shared_beginning(spark):
    names = F.concat(F.lit("warehouse-eu-central-"), F.lpad(F.col("id").cast("string"), 6, "0"))
    rows = spark.range(4096).select(names.alias("name"), F.encode(names, "UTF-8").alias("raw"))
    for column in ("name", "raw"):
        keyed = with_z_key(rows, [column], bits=6).orderBy(column).collect()
        cells = [r["_z"] for r in keyed]
        assert cells == sorted(cells)
        sizes = [cells.count(c) for c in range(64)]
        assert min(sizes) >= 16 and max(sizes) <= 256  # 64 each, up to the sample


def test_z_key_of_odd_texts(spark):
    rows = spark.createDataFrame(
        [(None, 1), ("", 2), ("", 2), ("é", 3), ("x" * 5000, 4), ("x" * 5000 + "y", 5)],
        "t string, n int",
    )
    keyed = {(r.t, r.n): r["_z"] for r in with_z_key(rows, ["t"], bits=3).collect()}
    assert keyed[None, 1] == 0 and keyed["", 2] <= keyed["x" * 5000, 4] <= keyed["é", 3]
    none = rows.filter("t IS NULL")
    assert [r["_z"] for r in with_z_key(none, ["t", "n"], bits=3).collect()] == [0]
    assert with_z_key(rows.filter("n > 9"), ["t", "n"], bits=3).count() == 0


def test_cells_follow_the_size(spark):
    # 128 MB files: 1 GB, 1 TB, 100 TB.
    assert [zorder_bits(files, 2) for files in (8, 8192, 819_200)] == [4, 8, 12]
    assert zorder_bits(819_200, 1) == 12 and zorder_bits(0, 16) == 3


def test_large_tables_are_cut_by_their_size(spark, folder):
    df = spark.range(30000).select(F.md5(F.col("id").cast("string")).alias("coin_id"), "id")
    df.write.parquet(f"{folder}/source")
    size = total_bytes(spark, f"{folder}/source")
    compact_zorder(spark, f"{folder}/source", f"{folder}/target", ["coin_id"], file_bytes=size // 20)
    back = spark.read.parquet(f"{folder}/target")
    assert back.exceptAll(df).count() == 0 and back.count() == 30000
    spans = back.groupBy(F.input_file_name()).agg(F.min("coin_id").alias("a"), F.max("coin_id").alias("b"))
    ends = sorted((r.a, r.b) for r in spans.collect())
    assert len(ends) >= 20 and all(b <= a for (_, b), (a, _) in zip(ends, ends[1:]))


def test_compaction_keeps_rows_and_narrows_files(spark, folder):
    df = spark.range(20000).select(
        F.concat(F.lit("coin"), F.col("id") % 997).alias("coin_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad(1 + F.col("id") % 28, 2, "0")))
        .cast("timestamp_ntz")
        .alias("updated_at"),
        "id",
    )
    # The last third are copies of one row.
    copies = spark.range(10000).select(F.lit("hot"), F.lit(None), F.lit(-1))
    rows = df.union(copies)
    rows.write.parquet(f"{folder}/source")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep all eight files
    try:
        compact_zorder(spark, f"{folder}/source", f"{folder}/target")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    back = spark.read.parquet(f"{folder}/target")
    assert back.count() == 30000 and back.exceptAll(rows).count() == 0
    sizes = back.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 30000 / 8 * 2


def test_run_log(spark, folder):
    counters = {"records_extracted": 200, "records_processed": 150}
    log_run(run_record(spark, "r1", "p", AT, "success", counters, 90.0, config={"k": 1}), folder)
    log_run(run_record(spark, "r2", "p", AT, "failed", error_message="why"), folder)
    rows = {r.run_id: r for r in spark.read.parquet(folder).drop("config_snapshot").collect()}
    assert rows["r1"].records_processed == 150 and rows["r1"].records_failed == 0
    assert rows["r1"].error_message == "" and rows["r2"].error_message == "why"
    from oreworks.plans.views import run_health, run_history

    history = {r.run_id: r for r in run_history(spark.read.parquet(folder)).collect()}
    assert history["r1"].success_rate_pct == 75.0 and history["r1"].execution_time_minutes == 1.5
    assert history["r2"].success_rate_pct == 0.0
    assert run_health(spark.read.parquet(folder), 1).count() == 1


def test_a_repeated_run_has_one_row(spark, folder):
    for status in ("failed", "success"):
        log_run(run_record(spark, "2024", "p", AT, status), folder)
    log_run(run_record(spark, "a/b c", "p", AT, "success"), folder)
    rows = spark.read.parquet(folder).select("run_id", "status").collect()
    assert sorted((r.run_id, r.status) for r in rows) == [("2024", "success"), ("a/b c", "success")]
    nameless = run_record(spark, "x", "p", AT, "success").withColumn("run_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="the run log needs run_id"):
        log_run(nameless, folder)


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root)
    assert child_names(spark, f"{root}/no-such-folder") == []


@pytest.mark.parametrize("extracted", [0, None])
def test_success_rate_without_records(spark, extracted):
    from oreworks.plans.views import run_history

    record = run_record(spark, "r", "p", AT, "success")
    record = record.withColumn("records_extracted", F.lit(extracted).cast("bigint"))
    assert run_history(record).first().success_rate_pct == 0.0
