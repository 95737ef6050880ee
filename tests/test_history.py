"""Type-2 history: each kind of change, the invariants, repeats, late batches, the upsert."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from oreworks.operators.history import as_of_versions, latest_per_key, scd2_changes
from oreworks.operators.merge import upsert
from oreworks.plans.gold_store import refresh_daily_summary, upsert_gold, write_daily_summary
from oreworks.sinks.silver_store import (
    LateBatchError,
    committed_runs,
    drop_superseded,
    merge_batch,
    read_current,
    read_versions,
)

SCHEMA = (
    "coin_id string, name string, current_price double, market_cap long, total_volume long, "
    "last_updated timestamp_ntz"
)
T = [datetime(2024, 1, d) for d in range(1, 10)]


def batch(spark, *rows):
    full = [(k, n, p, c, v, datetime(2024, 1, 1)) for k, n, p, c, v in rows]
    return spark.createDataFrame(full, SCHEMA)


A1, A2 = ("a", "A", 1.0, 10, 100), ("a", "A", 2.0, 10, 100)
B1 = ("b", "B", 5.0, 50, None)
B2 = ("b", "B", 5.0, 50, 7)
C1 = ("c", "C", 9.0, 90, 900)


def check_invariants(versions):
    per_key = {}
    for r in versions.collect():
        per_key.setdefault(r.coin_id, []).append(r)
    for rows in per_key.values():
        rows.sort(key=lambda r: r.valid_from)
        assert [r.is_current for r in rows[:-1]] == [False] * (len(rows) - 1)
        for earlier, later in zip(rows, rows[1:]):
            assert earlier.valid_to == later.valid_from
        assert rows[-1].is_current == (rows[-1].valid_to is None)


def test_chain_of_batches(spark, folder):
    merge = lambda t, *rows, **kw: merge_batch(
        spark, folder, batch(spark, *rows), t, **kw
    )
    assert merge(T[0], A1, B1) == {"new": 2, "version": 0, "closed": 0, "carried": 0}
    assert merge(T[1], A2, B1) == {"new": 0, "version": 1, "closed": 1, "carried": 1}
    # An unchanged batch opens nothing, although "a" has a closed version by now.
    assert merge(T[2], A2, B1) == {"new": 0, "version": 0, "closed": 0, "carried": 2}
    assert merge(T[3], A2, B1, C1) == {"new": 1, "version": 0, "closed": 0, "carried": 2}
    # null to value is a change; an untracked column is not.
    renamed = ("a", "other", 2.0, 10, 100)
    assert merge(T[4], renamed, B2) == {"new": 0, "version": 1, "closed": 1, "carried": 2}
    before = sorted(map(str, read_versions(spark, folder).collect()))
    # The same run again replaces its own output.
    assert merge(T[4], renamed, B2)["closed"] == 1
    assert sorted(map(str, read_versions(spark, folder).collect())) == before
    check_invariants(read_versions(spark, folder))
    with pytest.raises(LateBatchError):
        merge(T[2], A1)
    # Keys that are missing in a batch stay open unless that is switched off.
    assert merge(T[5], C1, close_missing=True) == {
        "new": 0, "version": 0, "closed": 2, "carried": 1,
    }
    current = read_current(spark, folder)
    assert [r.coin_id for r in current.collect()] == ["c"]
    assert read_versions(spark, folder).count() == 5
    assert committed_runs(spark, folder) == sorted(committed_runs(spark, folder))
    assert drop_superseded(spark, folder, keep=1) == 5
    assert read_versions(spark, folder).count() == 5
    # A key closed for good comes back as a new version chain.
    assert merge(T[6], A1, C1)["new"] == 1


def test_an_unfinished_run_is_not_seen(spark, folder):
    merge_batch(spark, folder, batch(spark, A1), T[0])
    stray = read_versions(spark, folder).withColumn("change", F.lit("new"))
    stray.drop("is_current").write.parquet(f"{folder}/run=t20240102T000000000000/is_current=true")
    assert len(committed_runs(spark, folder)) == 1
    assert read_current(spark, folder).count() == 1


def test_point_in_time(spark, folder):
    for t, rows in ((T[0], (A1, B1)), (T[2], (A2, B1)), (T[4], (A1, B2))):
        merge_batch(spark, folder, batch(spark, *rows), t)
    versions = read_versions(spark, folder)
    prices = lambda t: {
        r.coin_id: r.current_price for r in as_of_versions(versions, t).collect()
    }
    assert prices(T[1]) == {"a": 1.0, "b": 5.0}
    assert prices(T[2]) == {"a": 2.0, "b": 5.0}
    assert prices(T[8]) == {"a": 1.0, "b": 5.0}
    check_invariants(versions)


def test_new_columns_appear(spark, folder):
    merge_batch(spark, folder, batch(spark, A1), T[0])
    merge_batch(spark, folder, batch(spark, A2).withColumn("extra", F.lit("x")), T[1])
    found = {r.current_price: r.extra for r in read_versions(spark, folder).collect()}
    assert found == {1.0: None, 2.0: "x"}


def test_duplicate_keys_in_a_batch(spark):
    rows = [
        ("a", "old", 1.0, 1, 1, T[0]),
        ("a", "new", 2.0, 1, 1, T[1]),
        ("a", "new", 2.0, 1, 1, T[1]),
        ("a", "tie", 2.0, 1, 1, T[1]),
        ("b", "null time", 2.0, 1, 1, None),
    ]
    df = spark.createDataFrame(rows * 50, SCHEMA).repartition(5)
    kept = sorted((r.coin_id, r.name) for r in latest_per_key(df, ["coin_id"]).collect())
    assert kept == [("a", "tie"), ("b", "null time")]
    plan = latest_per_key(df, ["coin_id"])._jdf.queryExecution().executedPlan().toString()
    # Rows are dropped before the shuffle, so a key that repeats much costs nothing extra.
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:shuffle] and "WindowGroupLimit" in plan[shuffle:]


def test_merge_joins_once(spark):
    current = scd2_changes(None, batch(spark, A1), T[0]).drop("change")
    plan = scd2_changes(current, batch(spark, A2), T[1])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join FullOuter") == 1 and text.count("Join") == 1


def test_composite_keys(spark):
    rows = [("a", 1, 1.0), ("a", 2, 1.0)]
    schema = "k string, j int, v double"
    key = dict(key=["k", "j"], tracked=["v"])
    old = scd2_changes(None, spark.createDataFrame(rows, schema), T[0], **key).drop("change")
    new = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0)], schema)
    kinds = sorted((r.j, r.change) for r in scd2_changes(old, new, T[1], **key).collect())
    assert kinds == [(1, "carried"), (2, "closed"), (2, "version")]


def gold(spark, *rows):
    return spark.createDataFrame(
        rows,
        "metric_date date, market_cap_category string, num_coins long, metric_timestamp "
        "timestamp_ntz, created_at timestamp_ntz",
    )


def test_upsert_gold(spark, folder):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    upsert_gold(gold(spark, (d1, "L", 1, T[0], T[0]), (d2, "L", 5, T[0], T[0])), folder)
    # One key twice in the batch (the newer wins), one new class, one date not touched.
    again = gold(
        spark, (d1, "L", 2, T[1], T[1]), (d1, "L", 3, T[2], T[2]), (d1, "S", 9, T[1], T[1])
    )
    upsert_gold(again, folder)
    rows = {
        (r.metric_date, r.market_cap_category): (r.num_coins, r.created_at)
        for r in spark.read.parquet(folder).collect()
    }
    # created_at is not among the updated columns and keeps its first value.
    assert rows == {(d1, "L"): (3, T[0]), (d1, "S"): (9, T[1]), (d2, "L"): (5, T[0])}


def test_upsert_whole_row(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    rows = {r.k: (r.v, r.w) for r in upsert(old, new, ["k"]).collect()}
    assert rows == {1: ("a", None), 2: (None, "x"), 3: ("c", None)}


def silver_state(spark, *rows):
    return spark.createDataFrame(
        rows,
        "market_cap_category string, market_cap long, total_volume long, current_price double, "
        "price_change_percentage_24h double, price_volatility_24h double, is_price_anomaly "
        "boolean, is_volume_spike boolean, is_current boolean, updated_at timestamp_ntz",
    )


def test_refresh_of_a_day(spark, folder):
    row = ("L", 1, 1, 1.0, 1.0, 1.0, False, True, True)
    state = silver_state(spark, (*row, T[0]), (*row, T[1]), (*row, T[1]))
    assert write_daily_summary(state, folder, T[1]) == 2
    days = lambda: {
        r.summary_date: (r.num_coins, r.num_volume_spikes)
        for r in spark.read.parquet(folder).collect()
    }
    assert days() == {T[0].date(): (1, 1), T[1].date(): (2, 2)}
    moved = silver_state(spark, (*row, T[1]))
    assert refresh_daily_summary(moved, folder, T[1].date(), T[2]) == 1
    assert days() == {T[0].date(): (1, 1), T[1].date(): (1, 1)}
    # A day that has no rows any more disappears.
    assert refresh_daily_summary(moved, folder, T[0].date(), T[2]) == 0
    assert days() == {T[1].date(): (1, 1)}
