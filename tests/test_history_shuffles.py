"""A chain over rows that are unique per key and time has one shuffle of them, not two."""

from datetime import datetime

from oreworks.operators.history import scd2_chain


def test_unique_rows_are_shuffled_once(spark):
    rows = [("a", 1.0, datetime(2024, 1, d)) for d in (1, 2)] + [("b", 2.0, datetime(2024, 1, 1)), ("a", 3.0, datetime(2024, 1, 3))]
    frame = spark.createDataFrame(rows, "k string, v double, extracted_at timestamp_ntz")
    chains = [scd2_chain(None, frame, ["k"], ["v"], unique=u, seen_to="seen") for u in (False, True)]
    plain, short = (sorted(map(str, c.collect())) for c in chains)
    assert plain == short and len(short) == 3
    exchanges = [c._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") for c in chains]
    assert exchanges[1] < exchanges[0]
