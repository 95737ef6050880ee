"""Stored and merged quantile sketches against exact ranks."""

from datetime import date

from pyspark.sql import functions as F

from oreworks.operators.sketches import (
    merge_sketches,
    quantile_sketches,
    rank_errors,
    sketch_quantiles,
)
from oreworks.plans.gold_store import store_sketches, stored_quantiles

FRACTIONS = (0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0)


def prices(spark, rows=200_000):
    """A skewed value, half of all rows in one class, in ten days."""
    i = F.col("id")
    return spark.range(rows).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 10).cast("int")).alias("day"),
        F.when(i % 2 == 0, F.lit("big")).otherwise(F.concat(F.lit("c"), i % 5)).alias("class"),
        F.pow((F.xxhash64("id") % 1000) / 100.0, F.lit(3)).alias("price"),
    )


def test_merged_sketches_are_near_the_exact_ranks(spark):
    df = prices(spark)
    daily = quantile_sketches(df, "price", ["day", "class"])
    found = sketch_quantiles(merge_sketches(daily, ["class"]), FRACTIONS)
    errors = rank_errors(df, "price", ["class"], found.drop("num_rows")).collect()
    assert len(errors) == 6 * len(FRACTIONS)
    assert max(r.error for r in errors) < 0.01
    sizes = {r["class"]: r.num_rows for r in found.collect()}
    assert sizes["big"] == 100_000 and sum(sizes.values()) == 200_000


def test_small_groups_are_exact_and_odd_values_drop_out(spark):
    rows = [("a", float(v)) for v in range(11)] + [("a", None), ("a", float("nan")), ("n", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = sketch_quantiles(quantile_sketches(df, "v", ["g"]), [0.0, 0.5, 1.0]).collect()
    assert {(r.g, r.fraction): (r.value, r.num_rows) for r in found} == {
        ("a", 0.0): (0.0, 11),
        ("a", 0.5): (5.0, 11),
        ("a", 1.0): (10.0, 11),
        (None, 0.0): (4.0, 1),
        (None, 0.5): (4.0, 1),
        (None, 1.0): (4.0, 1),
    }
    none = quantile_sketches(df.filter("g = 'n'"), "v", ["g"])
    assert none.count() == 0
    assert sketch_quantiles(merge_sketches(none), [0.5]).count() == 0


def test_a_repeated_load_replaces_its_periods(spark, folder):
    df = prices(spark, 20_000)
    store_sketches(df, folder, "price", "day", ["class"])
    third = df.filter("day = '2024-01-03'")
    store_sketches(third, folder, "price", "day", ["class"])
    whole = stored_quantiles(spark, folder, [0.5], ["class"])
    assert whole.agg(F.sum("num_rows")).first()[0] == 20_000
    one = F.col("day") == F.lit(date(2024, 1, 3))
    chosen = stored_quantiles(spark, folder, [0.5], ["class"], one)
    assert chosen.agg(F.sum("num_rows")).first()[0] == third.count()
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
