"""Price momentum label from three change percentages."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Label, then the limits on the 1-day, 7-day and 30-day change, in order of test.
MOMENTUM_LEVELS = (
    ("STRONG_BULLISH", (5, 10, 20)),
    ("BULLISH", (2, 5)),
    ("STRONG_BEARISH", (-5, -10, -20)),
    ("BEARISH", (-2, -5)),
)
MOMENTUM_DEFAULT = "NEUTRAL"


def _beyond(changes: tuple[Column, ...], limits: tuple[int, ...]) -> Column:
    """Every change lies beyond its limit, on the side the limit's sign says."""
    tests = [(c > x) if x > 0 else (c < x) for c, x in zip(changes, limits)]
    met = tests[0]
    for test in tests[1:]:
        met = met & test
    return met


def momentum(change_1d: Column, change_7d: Column, change_30d: Column) -> Column:
    """A null comparison is not met, so the test falls through to the next level."""
    changes = (change_1d, change_7d, change_30d)
    levels = F
    for label, limits in MOMENTUM_LEVELS:
        levels = levels.when(_beyond(changes, limits), label)
    return levels.otherwise(MOMENTUM_DEFAULT)


def register_momentum(spark: SparkSession, name: str = "calculate_momentum") -> None:
    """Make the label available to SQL users; the optimizer inlines the body."""
    names = ("c1", "c7", "c30")
    branches = " ".join(
        "WHEN "
        + " AND ".join(f"{n} {'>' if x > 0 else '<'} {x}" for n, x in zip(names, limits))
        + f" THEN '{label}'"
        for label, limits in MOMENTUM_LEVELS
    )
    args = ", ".join(f"{n} DOUBLE" for n in names)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS STRING "
        f"RETURN CASE {branches} ELSE '{MOMENTUM_DEFAULT}' END"
    )
