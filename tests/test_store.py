"""The Silver store: which buckets a merge touches, what a failure leaves, and one history whatever the arrival."""

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from oreworks.sinks import manifest, silver_store
from oreworks.sinks.files import child_names, freed_after, materialize
from oreworks.sinks.silver_store import SnapshotLimits

T = [datetime(2024, 1, d) for d in range(1, 10)]
KIND = (
    "coin_id string, current_price double, market_cap long, total_volume long, "
    "market_cap_category string, last_updated timestamp_ntz, extracted_at timestamp_ntz"
)


def rows(spark, *given):
    """``(key, price, time[, updated[, volume]])``."""
    full = [(g[0], g[1], 1, g[4] if len(g) > 4 else 1, "c", g[3] if len(g) > 3 else g[2], g[2]) for g in given]
    return spark.createDataFrame(full, KIND)


def history(spark, root):
    found = silver_store.read_versions(spark, root)
    return sorted(tuple(str(r[c]) for c in sorted(found.columns)) for r in found.collect())


def spans(spark, root):
    found = silver_store.read_versions(spark, root).collect()
    assert all(r.valid_to is None or r.valid_from < r.valid_to for r in found)
    return sorted((r.coin_id, r.current_price, r.valid_from.day, r.valid_to and r.valid_to.day) for r in found)


def test_few_keys_write_only_their_buckets(spark, folder):
    many = spark.range(1000).selectExpr("CAST(id AS STRING) AS coin_id", "1.0D AS current_price", "1L AS market_cap", "1L AS total_volume")
    silver_store.merge_batch(spark, folder, many, T[0], buckets=64)
    few = many.filter("CAST(coin_id AS INT) % 100 = 7").withColumn("current_price", F.lit(2.0))
    expected = {r[0] for r in few.select(F.pmod(F.xxhash64("coin_id"), F.lit(64))).distinct().collect()}
    assert silver_store.merge_batch(spark, folder, few, T[1]) == {"new": 0, "version": 10, "closed": 10, "carried": 990}
    (take,) = child_names(spark, f"{folder}/run={silver_store.run_label(T[1])}")
    for flag in ("true", "false"):
        names = child_names(spark, f"{folder}/run={silver_store.run_label(T[1])}/{take}/is_current={flag}")
        assert {int(n.partition("=")[2]) for n in names} == expected
    current = silver_store.read_current(spark, folder)
    assert current.count() == 1000 and current.filter("current_price = 2").count() == 10
    assert silver_store.read_current(spark, folder, silver_store.run_label(T[0])).filter("current_price = 2").count() == 0
    assert silver_store.read_versions(spark, folder).count() == 1010
    assert silver_store.drop_superseded(spark, folder, keep=1) == 1
    assert silver_store.read_current(spark, folder).count() == 1000
    with pytest.raises(silver_store.FreedRunError):
        silver_store.read_current(spark, folder, silver_store.run_label(T[0]))


def test_a_repeat_that_fails_leaves_the_run(spark, folder, monkeypatch):
    for day, price in ((T[0], 1.0), (T[1], 2.0)):
        silver_store.merge_batch(spark, folder, rows(spark, ("a", price, day), ("b", 1.0, day)), day)
    before = history(spark, folder)
    broken = rows(spark, ("a", 9.0, T[1])).withColumn("market_cap", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        silver_store.merge_batch(spark, folder, broken, T[1])
    assert history(spark, folder) == before

    def stopped(*_):
        raise OSError("stopped before publishing")

    with monkeypatch.context() as m:
        m.setattr(manifest, "publish", stopped)
        with pytest.raises(OSError):
            silver_store.merge_batch(spark, folder, rows(spark, ("a", 9.0, T[1])), T[1])
    assert history(spark, folder) == before
    silver_store.merge_batch(spark, folder, rows(spark, ("a", 9.0, T[1])), T[1])
    assert spans(spark, folder) == [("a", 1.0, 1, 2), ("a", 9.0, 2, None), ("b", 1.0, 1, None)]
    assert silver_store.committed_runs(spark, folder) == [silver_store.run_label(t) for t in T[:2]]


def test_states_are_taken_once(spark, folder):
    assert manifest.latest(spark, folder) == (0, {})
    assert manifest.publish(spark, folder, 0, {"a": 1}) == 1
    with pytest.raises(manifest.ConcurrentWriteError):
        manifest.publish(spark, folder, 0, {"a": 2})
    assert manifest.latest(spark, folder) == (1, {"a": 1})
    # A state whose writer died in the middle is not one.
    from oreworks.sinks.files import create_text

    assert create_text(spark, f"{folder}/_states/{2:012d}.json", '{"a": ')
    assert manifest.latest(spark, folder) == (1, {"a": 1})
    assert manifest.publish(spark, folder, 1, {"a": 3}) == 3
    assert manifest.latest(spark, folder) == (3, {"a": 3})
    for n in range(3, 40):
        manifest.publish(spark, folder, n, {"a": n})
    assert len(child_names(spark, f"{folder}/_states")) <= manifest.KEPT_STATES + 1


SEEN = [
    ("a", 1.0, T[0]),
    ("a", 2.0, T[0], T[1]),
    ("a", 2.0, T[2]),
    ("a", 3.0, T[1]),
    ("b", 5.0, T[1], T[1]),
    ("b", 6.0, T[1], T[0]),
    ("b", 5.0, T[3]),
]
WANTED = [("a", 2.0, 1, 2), ("a", 2.0, 3, None), ("a", 3.0, 2, 3), ("b", 5.0, 2, None)]


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4, 5, 6), (6, 5, 4, 3, 2, 1, 0), (1, 0, 3, 2, 5, 4, 6), (3, 6, 0, 5, 2, 1, 4)])
def test_one_row_at_a_time_in_any_order(spark, folder, order):
    for n, i in enumerate(order):
        silver_store.merge_observations(spark, folder, rows(spark, SEEN[i]), f"p{n}", buckets=3)
    assert spans(spark, folder) == WANTED
    silver_store.merge_observations(spark, f"{folder}/once", rows(spark, *SEEN), "p0")
    assert history(spark, folder) == history(spark, f"{folder}/once")


def test_equal_times_leave_one_version(spark, folder):
    for n, prices in enumerate(itertools.permutations((1.0, 2.0))):
        root = f"{folder}/{n}"
        for part, price in enumerate(prices):
            silver_store.merge_observations(spark, root, rows(spark, ("a", price, T[0])), f"p{part}")
        assert spans(spark, root) == [("a", 2.0, 1, None)]


def test_late_rows_touch_only_their_buckets(spark, folder):
    keys = [f"k{i}" for i in range(40)]
    for n, day in enumerate((T[0], T[4])):
        silver_store.merge_observations(spark, folder, rows(spark, *[(k, float(n), day) for k in keys]), f"p{n}", buckets=16)
    late = rows(spark, ("k3", 7.0, T[2]), ("new", 8.0, T[2]))
    bucket = F.pmod(F.xxhash64("coin_id"), F.lit(16))
    expected = {r[0] for r in late.select(bucket).collect()}
    assert silver_store.merge_observations(spark, folder, late, "p2")["carried"] == 39
    run = manifest.latest(spark, folder)[1]["runs"][-1]
    assert set(run["touched"]) == expected and set(run["whole"]) <= expected and run["open_rows"] == 41
    found = spans(spark, folder)
    assert [f for f in found if f[0] in ("k3", "new")] == [("k3", 0.0, 1, 3), ("k3", 1.0, 5, None), ("k3", 7.0, 3, 5), ("new", 8.0, 3, None)]
    assert len(found) == 40 * 2 + 2
    # On time again: the run goes on from the open versions alone.
    silver_store.merge_observations(spark, folder, rows(spark, ("k3", 1.0, T[5]), ("k4", 2.0, T[5])), "p3")
    assert manifest.latest(spark, folder)[1]["runs"][-1]["whole"] == []
    assert len(spans(spark, folder)) == 40 * 2 + 3
    before = history(spark, folder)
    silver_store.rebucket(spark, folder, 5)
    assert history(spark, folder) == before
    silver_store.merge_observations(spark, folder, rows(spark, ("k3", 9.0, T[1])), "p4")
    assert [f for f in spans(spark, folder) if f[0] == "k3"] == [
        ("k3", 0.0, 1, 2), ("k3", 1.0, 5, None), ("k3", 7.0, 3, 5), ("k3", 9.0, 2, 3),
    ]


@pytest.mark.parametrize("cut", [5, 19])
def test_a_split_snapshot_is_flagged_as_a_whole(spark, folder, cut):
    snapshot = [(f"k{i}", 1.0, T[0], T[0], 10 + i % 3) for i in range(19)] + [("high", 1.0, T[0], T[0], 500)]
    for root, parts in (("whole", [snapshot]), ("split", [snapshot[:cut], snapshot[cut:]])):
        for n, part in enumerate(parts):
            silver_store.merge_observations(spark, f"{folder}/{root}", rows(spark, *part), f"p{n}", limits=SnapshotLimits())
    flagged = silver_store.read_current(spark, f"{folder}/split").filter("is_volume_spike").collect()
    assert [r.coin_id for r in flagged] == ["high"]
    assert history(spark, f"{folder}/whole") == history(spark, f"{folder}/split")
    # A later snapshot has limits of its own; the first one's versions keep theirs.
    silver_store.merge_observations(spark, f"{folder}/split", rows(spark, ("high", 2.0, T[1], T[1], 9)), "p9", limits=SnapshotLimits())
    closed = silver_store.read_versions(spark, f"{folder}/split").filter("NOT is_current").collect()
    assert [(r.coin_id, r.is_volume_spike) for r in closed] == [("high", True)]


def test_only_the_last_part_is_replaced(spark, folder):
    for n in (0, 1, 1):
        silver_store.merge_observations(spark, folder, rows(spark, ("a", float(n), T[n])), f"p{n}")
    assert spans(spark, folder) == [("a", 0.0, 1, 2), ("a", 1.0, 2, None)]
    with pytest.raises(silver_store.LateBatchError):
        silver_store.merge_observations(spark, folder, rows(spark, ("a", 1.0, T[3])), "p0")


def test_closing_all_and_coming_back(spark, folder):
    silver_store.merge_batch(spark, folder, rows(spark, ("a", 1.0, T[0])), T[0])
    silver_store.merge_batch(spark, folder, rows(spark).limit(0), T[1], close_missing=True)
    assert silver_store.read_current(spark, folder).count() == 0
    assert silver_store.merge_batch(spark, folder, rows(spark, ("a", 1.0, T[2])), T[2])["new"] == 1
    assert spans(spark, folder) == [("a", 1.0, 1, 2), ("a", 1.0, 3, None)]


def test_scratch_of_a_step_goes_with_it(spark):
    with freed_after(spark):
        kept = materialize(spark.range(3), "step")
        path = kept.inputFiles()[0].rpartition("/")[0]
        assert kept.count() == 3 and child_names(spark, path)
    assert child_names(spark, path) == []
