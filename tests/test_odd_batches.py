"""Inputs that the registered queries never send: replays, null keys, empty batches, error pages."""

from datetime import datetime

import pytest

from oreworks.config import RowRules
from oreworks.functions import utc_timestamp
from oreworks.operators.checks import zscore_report
from oreworks.plans.batch_run import Layout, run_batch
from oreworks.schemas import BRONZE_SCHEMA
from oreworks.sinks import silver_store
from oreworks.sources import landing

DAYS = [datetime(2024, 1, d) for d in (1, 2, 3)]


def batch(spark, *rows):
    return spark.createDataFrame(rows, "coin_id string, current_price double, market_cap long, total_volume long")


def versions(spark, root):
    return sorted(
        (r.coin_id, r.current_price, r.valid_from, r.is_current)
        for r in silver_store.read_versions(spark, root).collect()
    )


def test_replay_after_freeing_keeps_history(spark, folder):
    batches = [batch(spark, ("a", float(i), 1, 1), ("b", 1.0, 1, 1)) for i in range(3)]
    for day, rows in zip(DAYS, batches, strict=True):
        silver_store.merge_batch(spark, folder, rows, day)
    before = versions(spark, folder)
    silver_store.drop_superseded(spark, folder, keep=1)
    with pytest.raises(silver_store.FreedRunError):
        silver_store.merge_batch(spark, folder, batches[2], DAYS[2])
    assert versions(spark, folder) == before
    assert silver_store.drop_superseded(spark, folder, keep=1) == 0


def test_null_keys_are_rejected(spark, folder):
    for day in DAYS:
        rows = batch(spark, (None, 1.0, 1, 1), ("a", 1.0, 1, 1))
        silver_store.merge_batch(spark, folder, rows, day)
    assert [v[0] for v in versions(spark, folder)] == ["a"]
    assert spark.read.parquet(f"{folder}_rejected").count() == 3


def test_empty_batch_makes_no_run(spark, folder):
    none = batch(spark).limit(0)
    assert sum(silver_store.merge_batch(spark, folder, none, DAYS[0]).values()) == 0
    assert silver_store.committed_runs(spark, folder) == []
    silver_store.merge_batch(spark, folder, batch(spark, ("a", 1.0, 1, 1)), DAYS[1])
    silver_store.merge_batch(spark, folder, none, DAYS[2])
    assert len(versions(spark, folder)) == 1


def test_invalid_batch_does_not_stop_later_ones(spark, folder):
    layout = Layout(folder)
    records = lambda price: spark.createDataFrame(
        [tuple({"id": "a", "symbol": "a", "name": "a", "current_price": price, "extracted_at": "2024-01-01T00:00:00", "source": "x"}.get(f.name) for f in BRONZE_SCHEMA)],
        BRONZE_SCHEMA,
    )
    rules = RowRules(not_null=("id", "current_price"))
    assert run_batch(spark, records(None), layout, DAYS[0], rules, 0.5)["records_failed"] == 1
    assert run_batch(spark, records(2.0), layout, DAYS[1], rules, 0.5)["new"] == 1
    log = {r.run_id: r for r in spark.read.parquet(layout.runs).collect()}
    assert len(log) == 2 and all(r.execution_time_seconds > 0 and r.completed_at > r.started_at for r in log.values())


def test_error_pages(spark, tmp_path):
    pages = {1: '[{"id": "a"}]', 2: '{"status": {"error_code": 429}}', 3: '"oops"', 4: '[{"id": "b"', 5: "[]", 6: ""}
    for n, text in pages.items():
        (tmp_path / f"page_{n}.json").write_text(text)
    assert [r.id for r in landing.read_pages(spark, str(tmp_path)).collect()] == ["a"]
    failed = {r.extraction_page for r in landing.failed_pages(spark, str(tmp_path)).collect()}
    assert failed >= {2, 3, 4} and not failed & {1, 5}


def test_zscore_skips_nan(spark):
    values = [(float(i % 5),) for i in range(50)] + [(float("nan"),), (1000.0,)]
    report = zscore_report(spark.createDataFrame(values, "x double"), ["x"]).collect()
    assert {r.metric: r.value for r in report}["anomaly_count"] == 1


@pytest.mark.parametrize(
    ("text", "hour"),
    [("2024-01-01 00:00:00+02:00", 22), ("2024-01-01T00:00:00+02", 22), ("2024-01-01T00:00:00-0130", 1), ("2024-01-01 00:00:00 +02:00", 22), ("2024-01-01T05:00:00Z", 5), ("2024-01-01", 0)],
)
def test_offsets(spark, text, hour):
    found = spark.createDataFrame([(text,)], "t string").select(utc_timestamp("t").alias("t")).first().t
    assert found.hour == hour
