"""The whole way from landed files to Gold, in batches and incrementally."""

import json
from datetime import datetime
from pathlib import Path

import pytest

from oreworks.config import RowRules
from oreworks.plans.batch_run import Layout, rejected, run_batch
from oreworks.plans.views import (
    category_comparison,
    current_market_state,
    register_views,
    top_movers,
    volatility_estimate,
)
from oreworks.sinks.silver_store import (
    committed_runs,
    merge_batch,
    merge_observations,
    read_current,
    read_versions,
)
from oreworks.sources.landing import read_json_arrays
from oreworks.streaming.incremental import incremental_silver

RULES = RowRules(not_null=("id", "symbol", "name", "current_price"))
DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def records(day, *coins):
    base = dict(total_volume=10, high_24h=3.0, low_24h=2.0, ath=9.0, atl=1.0, source="feed")
    stamp = day.isoformat() + "Z"
    return [
        base
        | dict(id=i, symbol=i.upper(), name=i, extracted_at=stamp, last_updated=stamp)
        | dict(current_price=p, market_cap=c, price_change_percentage_24h=ch)
        for i, p, c, ch in coins
    ]


FIRST = records(DAY1, ("a", 1.0, 2 * 10**10, 60.0), ("b", 2.0, 5, -3.0), ("bad", None, 5, 0.0))
SECOND = records(DAY2, ("a", 1.5, 2 * 10**10, 50.0), ("b", 2.0, 5, -3.0), ("c", 7.0, 2 * 10**9, 0.0))


def land(folder, name, rows, lines=False):
    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    text = "\n".join(json.dumps(r) for r in rows) if lines else json.dumps(rows, indent=1)
    (path / name).write_text(text)


def test_two_batches(spark, folder):
    layout = Layout(f"{folder}/tables")
    results = []
    for day, rows in ((DAY1, FIRST), (DAY2, SECOND)):
        land(f"{folder}/{day:%d}", "crypto_1.json", rows)
        found = read_json_arrays(spark, f"{folder}/{day:%d}/*.json")
        results.append(run_batch(spark, found, layout, day, RULES, 0.5))
    assert results[0]["records_failed"] == 1 and results[0]["new"] == 2
    assert results[1]["version"] == 1 and results[1]["carried"] == 1 and results[1]["new"] == 1

    reasons = rejected(spark, layout, DAY1).first()
    assert reasons.id == "bad" and list(reasons.validation_errors) == ["current_price_is_null"]

    current = read_current(spark, layout.silver)
    state = {r.coin_id: r for r in current_market_state(current).collect()}
    assert state["a"].current_price == 1.5 and state["a"].is_price_anomaly is False
    assert state["b"].updated_at == DAY1 and state["c"].market_cap_category == "Mid Cap"
    movers = [(r.coin_id, r.movement_type) for r in top_movers(current).collect()]
    assert movers == [("a", "GAINER"), ("b", "LOSER"), ("c", "LOSER")]

    gold = spark.read.parquet(layout.gold)
    assert gold.count() == 5  # two classes on the first day, three on the second
    compared = category_comparison(gold, DAY2.date()).collect()
    assert [r.market_cap_category for r in compared] == ["Large Cap", "Mid Cap", "Small Cap"]
    pruned = category_comparison(gold, DAY2.date())._jdf.queryExecution().executedPlan().toString()
    assert "metric_date" in pruned[pruned.index("PartitionFilters") : pruned.index("PushedFilters")]

    runs = spark.read.parquet(layout.runs)
    assert sorted((r.run_id, r.status) for r in runs.select("run_id", "status").collect()) == [
        ("20240101000000", "success"),
        ("20240102000000", "success"),
    ]
    register_views(read_versions(spark, layout.silver), gold, runs, datetime(2024, 1, 5))
    history = spark.sql("SELECT * FROM v_price_history WHERE coin_id = 'a'").collect()
    assert [(r.current_price, r.days_at_price) for r in history] == [(1.5, 3), (1.0, 1)]
    ranks = spark.sql("SELECT coin_id, dominance_rank FROM v_market_dominance").collect()
    assert [tuple(r) for r in ranks] == [("a", 1), ("c", 2), ("b", 3)]
    assert spark.sql("SELECT * FROM v_volatility_analysis").count() == 3
    assert volatility_estimate(current).count() == 3
    assert spark.sql("SELECT * FROM v_pipeline_execution_history").count() == 2


def test_a_second_run_of_a_day_keeps_when_its_rows_were_made(spark, folder):
    layout = Layout(f"{folder}/lake")
    land(f"{folder}/{DAY1:%d}", "crypto_1.json", FIRST)
    for at in (DAY1, DAY1.replace(hour=5)):
        found = read_json_arrays(spark, f"{folder}/{DAY1:%d}")
        run_batch(spark, found, layout, at, RULES, 0.5)
    row = spark.read.parquet(layout.gold).first()
    assert row.created_at == DAY1 and row.metric_timestamp == DAY1.replace(hour=5)


def test_a_failed_run_is_logged(spark, folder):
    layout = Layout(folder)
    broken = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(Exception):
        run_batch(spark, broken, layout, DAY1, RULES, 0.5)
    row = spark.read.parquet(layout.runs).select("status", "error_message").first()
    assert row.status == "failed" and row.error_message


def test_incremental_equals_batches_and_repeats_nothing(spark, folder):
    landing, root, checkpoint = (f"{folder}/{n}" for n in ("landing", "silver", "checkpoint"))

    def step():
        incremental_silver(spark, landing, root, checkpoint, RULES, 0.5)

    land(landing, "one.json", FIRST, lines=True)
    step()
    step()  # nothing new: no run
    assert len(committed_runs(spark, root)) == 1
    land(landing, "two.json", SECOND, lines=True)
    step()
    assert len(committed_runs(spark, root)) == 2
    streamed = read_versions(spark, root)

    layout = Layout(f"{folder}/batch")
    for day, rows in ((DAY1, FIRST), (DAY2, SECOND)):
        land(f"{folder}/{day:%d}", "x.json", rows)
        run_batch(spark, read_json_arrays(spark, f"{folder}/{day:%d}"), layout, day, RULES, 0.5)
    batched = read_versions(spark, layout.silver).select(*streamed.columns)
    assert streamed.count() == 4 and streamed.exceptAll(batched).count() == 0

    # A batch without a valid row makes no run.
    land(landing, "empty.json", records(DAY2, ("n", None, 1, 0.0)), lines=True)
    step()
    assert len(committed_runs(spark, root)) == 2


DAY3 = datetime(2024, 1, 3)
THIRD = records(DAY3, ("a", 1.0, 2 * 10**10, 50.0), ("b", 2.0, 5, -3.0), ("d", 4.0, 5, 0.0))


def history(spark, root):
    rows = read_versions(spark, root)
    return sorted(tuple(str(r[c]) for c in sorted(rows.columns)) for r in rows.collect())


@pytest.mark.parametrize("arrivals", [((0, 1, 2),), ((0, 2), (1,)), ((1, 2), (0, 0))])
def test_history_does_not_depend_on_arrival(spark, folder, arrivals):
    """Snapshots at once, one by one or out of order give the history of three batches in order."""
    days = list(zip((DAY1, DAY2, DAY3), (FIRST, SECOND, THIRD), strict=True))
    layout = Layout(f"{folder}/batch")
    for day, rows in days:
        land(f"{folder}/{day:%d}", "x.json", rows)
        run_batch(spark, read_json_arrays(spark, f"{folder}/{day:%d}"), layout, day, RULES, 0.5)
    landing, root, checkpoint = (f"{folder}/{n}" for n in ("landing", "silver", "checkpoint"))
    for step, group in enumerate(arrivals):
        for place, i in enumerate(group):
            land(landing, f"{step}_{place}.json", days[i][1], lines=True)
        incremental_silver(spark, landing, root, checkpoint, RULES, 0.5)
    assert history(spark, root) == history(spark, layout.silver)
    assert len(committed_runs(spark, root)) == len(arrivals)


def test_a_late_batch_joins_versions_of_other_merges(spark, folder):
    """Versions that a batch merge made are kept, those of late keys split at the late time."""
    kind = "coin_id string, current_price double, market_cap long, total_volume long, extracted_at timestamp_ntz"
    rows = lambda *r: spark.createDataFrame(list(r), kind)
    for day, price in ((DAY1, 1.0), (DAY3, 3.0)):
        merge_batch(spark, folder, rows(("a", price, 1, 1, day), ("b", 1.0, 1, 1, day)), day)
    late = rows(("a", 2.0, 1, 1, DAY2), ("n", 9.0, 1, 1, DAY1), ("n", 9.0, 1, 1, None), (None, 1.0, 1, 1, DAY1))
    for _ in range(2):  # the second time replaces the run
        merge_observations(spark, folder, late, "p1")
        found = read_versions(spark, folder)
        got = sorted((r.coin_id, r.current_price, r.valid_from, r.valid_to) for r in found.filter("coin_id <> 'b'").collect())
        assert got[:3] == [("a", 1.0, DAY1, DAY2), ("a", 2.0, DAY2, DAY3), ("a", 3.0, DAY3, None)]
        assert got[3] == ("n", 9.0, DAY1, None) and found.count() == 5
        assert spark.read.parquet(f"{folder}_rejected/run=p1").count() == 2
    assert read_current(spark, folder).count() == 3
    merge_observations(spark, folder, rows().limit(0), "p2")
    assert len(committed_runs(spark, folder)) == 3


def test_parts_of_one_extraction_arrive_one_by_one(spark, folder):
    landing, root, checkpoint = (f"{folder}/{n}" for n in ("landing", "silver", "checkpoint"))
    land(landing, "p1.json", records(DAY1, ("a", 1.0, 5, 0.0)), lines=True)
    land(landing, "p2.json", records(DAY1, ("b", 2.0, 5, 0.0)), lines=True)
    incremental_silver(spark, landing, root, checkpoint, RULES, 0.5, max_files=1)
    assert len(committed_runs(spark, root)) == 2
    assert sorted(r.coin_id for r in read_current(spark, root).collect()) == ["a", "b"]


def test_records_that_break_the_contract_of_bronze_fail(spark, folder):
    """The rules ask for a price only; the contract of the table still holds."""
    layout = Layout(f"{folder}/tables")
    rows = records(DAY1, ("a", 1.0, 5, 0.0), ("b", 2.0, 5, 0.0), ("c", 3.0, 5, 0.0))
    rows[1]["source"] = None
    rows[2]["name"] = None
    land(f"{folder}/in", "crypto_1.json", rows)
    found = read_json_arrays(spark, f"{folder}/in/*.json")
    counts = run_batch(spark, found, layout, DAY1, RowRules(not_null=("current_price",)), 0.5)
    assert (counts["records_failed"], counts["records_processed"], counts["new"]) == (2, 1, 1)
    reasons = {r.id: r.validation_errors for r in rejected(spark, layout, DAY1).collect()}
    assert reasons == {"b": ["source_is_null"], "c": ["name_is_null"]}
    assert [r.coin_id for r in read_current(spark, layout.silver).collect()] == ["a"]
