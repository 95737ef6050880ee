"""Quantiles from mergeable sketches: stored per period and class, merged over any choice of them.

A KLL sketch keeps a bounded sample of ranked values. Sketches of parts merge into a sketch of the
whole, so a quantile over many periods reads one small row per period and class instead of the rows.
The exact form is :func:`oreworks.operators.ranking.exact_percentile`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rank errors stay below 0.35 % of the rows in 99 of 100 sketches of this size, also after merges.
SKETCH_SIZE = 800


def quantile_sketches(
    df: DataFrame, value: str, groups: Sequence[str], size: int = SKETCH_SIZE
) -> DataFrame:
    """``(*groups, sketch)`` of the values that are numbers; a group without any has no row.

    Sketches combine before the shuffle, so a large group is one sketch per task by then. The
    choice of kept values is random: two runs may differ within the error.
    """
    number = F.col(value).cast("double")
    held = df.filter(number.isNotNull() & ~F.isnan(number))
    return held.groupBy(*groups).agg(F.kll_sketch_agg_double(number, F.lit(size)).alias("sketch"))


def merge_sketches(
    sketches: DataFrame, groups: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """Sketches of coarser groups; without groups and rows one row with an empty sketch."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """One row per sketch and fraction: ``fraction, value, num_rows`` next to the groups."""
    groups = [c for c in sketches.columns if c != "sketch"]
    rows = F.kll_sketch_get_n_double("sketch")
    points = [
        F.struct(
            F.lit(float(f)).alias("fraction"),
            F.kll_sketch_get_quantile_double("sketch", F.lit(float(f))).alias("value"),
            rows.alias("num_rows"),
        )
        for f in fractions
    ]
    return sketches.filter(rows > 0).select(*groups, F.inline(F.array(*points)))


def rank_errors(
    df: DataFrame, value: str, groups: Sequence[str], quantiles: DataFrame
) -> DataFrame:
    """How far each quantile's fraction lies outside of the ranks that its value has in ``df``.

    ``quantiles`` has a row per group and fraction and joins the rows by group; Spark broadcasts it
    by its measured size.
    """
    renamed = quantiles.withColumnsRenamed({g: f"_{g}" for g in groups} | {"value": "_at"})
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = df.filter(F.col(value).isNotNull()).join(renamed, same)
    number = F.col(value).cast("double")
    counted = joined.groupBy(*groups, "fraction").agg(
        F.count("*").alias("n"),
        F.count_if(number < F.col("_at")).alias("below"),
        F.count_if(number <= F.col("_at")).alias("up_to"),
    )
    outside = F.greatest(
        F.col("below") / F.col("n") - F.col("fraction"),
        F.col("fraction") - F.col("up_to") / F.col("n"),
        F.lit(0.0),
    )
    return counted.select(*groups, "fraction", F.col("n").alias("num_rows"), outside.alias("error"))
