from datetime import datetime

from pyspark.sql import functions as F

from oreworks.config import INCLUSIVE_CAPS, STRICT_CAPS, CapBuckets
from oreworks.functions import (
    cap_category,
    days_between,
    exact_sum,
    momentum,
    percent_of,
    register_momentum,
    ts_literal,
    utc_timestamp,
)


def values(df, column="x"):
    return [r[column] for r in df.collect()]


def test_category_edges(spark):
    df = spark.createDataFrame(
        [(1, 10**10 + 1), (2, 10**10), (3, 10**9 + 1), (4, 10**9), (5, None)], "i int, cap long"
    )
    strict = values(df.select(cap_category(F.col("cap"), STRICT_CAPS).alias("x")))
    assert strict == ["Large Cap", "Mid Cap", "Mid Cap", "Small Cap", "Small Cap"]
    inclusive = values(df.select(cap_category(F.col("cap"), INCLUSIVE_CAPS).alias("x")))
    assert inclusive == ["LARGE_CAP", "LARGE_CAP", "MID_CAP", "MID_CAP", "SMALL_CAP"]
    named = CapBuckets(((5, "big"),), "small", null_label="unknown")
    assert values(df.select(cap_category(F.col("cap"), named).alias("x")))[-1] == "unknown"
    assert named.labels == ("big", "small", "unknown")


MOMENTUM_CASES = [
    ((6.0, 11.0, 21.0), "STRONG_BULLISH"),
    ((5.0, 11.0, 21.0), "BULLISH"),
    ((6.0, 10.0, 21.0), "BULLISH"),
    ((6.0, 11.0, 20.0), "BULLISH"),
    ((6.0, 11.0, None), "BULLISH"),
    ((2.0, 6.0, 0.0), "NEUTRAL"),
    ((3.0, 5.0, 0.0), "NEUTRAL"),
    ((-6.0, -11.0, -21.0), "STRONG_BEARISH"),
    ((-5.0, -11.0, -21.0), "BEARISH"),
    ((-6.0, -11.0, None), "BEARISH"),
    ((-2.0, -6.0, -30.0), "NEUTRAL"),
    ((None, 11.0, 21.0), "NEUTRAL"),
    ((6.0, None, 21.0), "NEUTRAL"),
]


def test_momentum_branches(spark):
    rows = [(i, *changes) for i, (changes, _) in enumerate(MOMENTUM_CASES)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double")
    register_momentum(spark)
    found = df.select(
        "i",
        momentum(F.col("a"), F.col("b"), F.col("c")).alias("x"),
        F.expr("calculate_momentum(a, b, c)").alias("y"),
    ).orderBy("i")
    wanted = [label for _, label in MOMENTUM_CASES]
    assert values(found) == wanted
    assert values(found, "y") == wanted


def test_percent_of_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 4.0), (1.0, None)], "a double, b double")
    assert values(df.select(percent_of(F.col("a"), F.col("b")).alias("x"))) == [None, 25.0, None, None]


def test_exact_sum_beyond_long(spark):
    df = spark.createDataFrame([(2**63 - 1,), (2**63 - 1,)], "a long")
    assert int(df.agg(exact_sum(F.col("a")).alias("x")).first()["x"]) == 2 * (2**63 - 1)


def test_times_do_not_depend_on_session_zone(spark):
    texts = [
        "2024-03-10T02:30:00Z",  # this hour does not exist in the session's zone
        "2024-03-10T02:30:00.250",
        "2024-03-10T02:30:00+05:30",
        "2024-03-10T02:30:00-0200",
        "2024-03-10",
        "x",
        "",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert values(df.select(utc_timestamp("t").alias("x"))) == [
        datetime(2024, 3, 10, 2, 30),
        datetime(2024, 3, 10, 2, 30, 0, 250000),
        datetime(2024, 3, 9, 21, 0),
        datetime(2024, 3, 10, 4, 30),
        datetime(2024, 3, 10),
        None,
        None,
        None,
    ]
    moment = datetime(2024, 3, 10, 2, 30, 0, 5)
    assert spark.range(1).select(ts_literal(moment).alias("x")).first()["x"] == moment


def test_days_count_boundaries(spark):
    start, end = datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2, 0, 1)
    df = spark.range(1).select(days_between(ts_literal(start), ts_literal(end)).alias("x"))
    assert values(df) == [1]
