"""Numbering value ranges by binary search over limits that come from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_limits(number: Column, bits: int) -> Column:
    """Aggregate: approximate quantiles that cut the values into ``2 ** bits`` ranges.

    The error is a small part of a range. It makes ranges somewhat uneven, and nothing else.
    """
    cells = 1 << bits
    steps = [i / cells for i in range(1, cells)]
    return F.percentile_approx(number, steps, accuracy=16 * cells)


def with_range_number(
    df: DataFrame, number: Column, limits: Column, bits: int, output: str
) -> DataFrame:
    """Add the count of limits below ``number``; null numbers and missing limits give zero.

    ``limits`` is an ascending array of ``2 ** bits - 1`` values, usually a one-row subquery. Each
    step halves the choice, so a row takes ``bits`` comparisons, all inside generated code.
    """
    found = df.withColumn("_limits", limits).withColumn(output, F.lit(0))
    for bit in reversed(range(bits)):
        step = 1 << bit
        here = F.col(output)
        above = F.col("_limits")[here + F.lit(step - 1)] < number
        found = found.withColumn(output, F.when(above, here + F.lit(step)).otherwise(here))
    return found.drop("_limits")
