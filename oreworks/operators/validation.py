"""Row-level validation: every row gets its list of error codes in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.config import RowRules


def row_errors(rules: RowRules) -> Column:
    """Array of error codes of a row, each code once, in rule order."""
    found: dict[str, Column] = {}
    if not (rules.not_null or rules.numeric or rules.ranges or rules.non_negative):
        return F.array().cast("array<string>")
    for c in rules.not_null:
        found[f"{c}_is_null"] = F.col(c).isNull()
    for c in rules.numeric:
        found[f"{c}_not_numeric"] = F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()
    for c, (low, high) in rules.ranges.items():
        found[f"{c}_out_of_range"] = out_of_range(F.col(c).try_cast("double"), low, high)
    for c in rules.non_negative:
        found[f"{c}_negative"] = F.col(c).try_cast("double") < 0
    return codes(found)


def codes(tests: dict[str, Column]) -> Column:
    """The codes whose test is met; taking nulls out this way stays in generated code."""
    nothing = F.array(F.lit(None).cast("string"))
    return F.array_except(F.array(*[F.when(t, code) for code, t in tests.items()]), nothing)


def out_of_range(column: Column, low: float | None, high: float | None) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (column < F.lit(float(low)))
    if high is not None:
        outside = outside | (column > F.lit(float(high)))
    return F.coalesce(outside, F.lit(False))


def flag_rows(df: DataFrame, rules: RowRules) -> DataFrame:
    """Add ``validation_errors`` and ``is_valid``."""
    return df.withColumn("validation_errors", row_errors(rules)).withColumn(
        "is_valid", F.size("validation_errors") == 0
    )


def split_rows(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the flags, and invalid rows with their reasons."""
    valid = flagged.filter("is_valid").drop("is_valid", "validation_errors")
    return valid, flagged.filter(~F.col("is_valid"))


def validate(df: DataFrame, rules: RowRules) -> tuple[DataFrame, DataFrame]:
    return split_rows(flag_rows(df, rules))


def flag_payloads(df: DataFrame, payload: str, required: Sequence[str]) -> DataFrame:
    """Flag semi-structured records that lack a required field (absent or JSON null)."""
    missing = {
        f"{f}_is_null": F.try_variant_get(F.col(payload), f"$.{f}", "string").isNull()
        for f in required
    }
    return df.withColumn("validation_errors", codes(missing)).withColumn(
        "is_valid", F.size("validation_errors") == 0
    )
