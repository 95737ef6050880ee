"""Ranking, percentiles and joins: exact against the plain form, and balanced under skew."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreworks.operators.ranking import exact_percentile, global_rank, share_of_total, value_positions
from oreworks.operators.skew import balanced_join, salted_join
from oreworks.sinks.files import materialize


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one key and one value; some are null."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        if i % 3 == 0:
            rows.append((i, "hot", 1000))
        elif i % 50 == 1:
            rows.append((i, None, None))
        else:
            rows.append((i, f"k{rng.randrange(2000)}", rng.randrange(1500)))
    return materialize(spark.createDataFrame(rows, "id long, k string, v long"), "skewed")


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    order = sorted(left.columns)
    rows = lambda df: sorted(map(str, df.select(*order).collect()))
    assert rows(left) == rows(right)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_global_rank_is_exact(skewed, descending, ranges):
    order = F.col("v").desc() if descending else F.col("v").asc()
    plain = skewed.filter("v IS NOT NULL").withColumn(
        "rank", F.rank().over(Window.orderBy(order)).cast("bigint")
    )
    nulls = skewed.filter("v IS NULL").withColumn("rank", F.lit(None).cast("bigint"))
    same(global_rank(skewed, "v", descending=descending, ranges=ranges), plain.union(nulls))


def test_rank_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(1, 5), (2, 5)], "id int, v int")
    assert {r["rank"] for r in global_rank(one, "v").collect()} == {1}
    assert global_rank(one.filter("id > 9"), "v").count() == 0


def test_rank_moves_no_row_to_a_single_task(skewed):
    plan = value_positions(skewed, "v")._jdf.queryExecution().executedPlan().toString()
    # The whole-table window sorts the ranges only: at most one row per range reaches it.
    for line in plan.split("\n"):
        if "Window [" in line and "_range_n" not in line:
            assert "_range" in line.split("],")[-2]


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentile_is_exact(skewed, fraction):
    grouped = skewed.withColumn("g", F.col("id") % 4)
    plain = grouped.groupBy("g").agg(F.percentile("v", fraction).alias("p"))
    ours = exact_percentile(grouped, "v", fraction, ["g"], "p", ranges=9)
    wanted = {r.g: r.p for r in plain.collect()}
    found = {r.g: float(r.p) for r in ours.collect()}
    assert found == pytest.approx(wanted)


def test_median_of_small_groups(spark):
    rows = [("two", 1.0), ("two", 2.0), ("four", 1.0), ("four", 2.0), ("four", 10.0),
            ("four", 20.0), ("one", 3.0), (None, 4.0), (None, 8.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for limit in (None, 5):
        found = exact_percentile(df, "v", 0.5, ["g"], "m", limit).collect()
        assert {r.g: r.m for r in found} == {"two": 1.5, "four": 6.0, "one": 3.0, None: 6.0}


def test_share_of_total(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "v long")
    shares = [r.s for r in share_of_total(df, "v", "s").collect()]
    assert shares == [25.0, 75.0, None]
    plan = share_of_total(df, "v", "s")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_balanced_join_equals_the_plain_join(spark, skewed, how, null_safe):
    lookup = spark.createDataFrame(
        [("hot", 1), (None, 2), *[(f"k{i}", i) for i in range(0, 2500, 2)]], "k string, w int"
    )
    renamed = lookup.withColumnRenamed("k", "k2")
    same_key = F.col("k").eqNullSafe(F.col("k2")) if null_safe else F.col("k") == F.col("k2")
    plain = skewed.join(renamed, same_key, how).drop("k2")
    same(balanced_join(skewed, lookup, ["k"], how, null_safe=null_safe), plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, skewed, how):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, w int")
    same(salted_join(skewed, lookup, ["k"], how, ["id"]), skewed.join(lookup, "k", how))


def test_heavy_rows_are_not_shuffled(spark, skewed):
    """Without any automatic broadcast the heavy branch still has no shuffle of the rows."""
    lookup = materialize(
        spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, w int"), "lookup"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = balanced_join(skewed, lookup, ["k"], "inner")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    heavy = plan[: plan.index("SortMergeJoin")]
    assert "BroadcastHashJoin" in heavy and "LeftSemi" in heavy
