"""Keyed upsert of one frame into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    old: DataFrame, new: DataFrame, key: Sequence[str], updated: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``old`` with the ``updated`` columns taken from ``new`` on a key match, plus new keys.

    Both sides hold one row per key. With ``updated=None`` a match replaces the whole row.
    """
    key = list(key)
    kinds = {f.name: f.dataType for f in (*old.schema.fields, *new.schema.fields)}
    others = [c for c in kinds if c not in key]
    replaced = set(others if updated is None else updated)
    left = old.withColumnsRenamed({c: f"_o_{c}" for c in old.columns if c not in key})
    right = new.withColumnsRenamed({c: f"_n_{c}" for c in new.columns if c not in key})
    left, right = left.withColumn("_in_o", F.lit(True)), right.withColumn("_in_n", F.lit(True))
    joined = left.join(right, key, "full_outer")

    def value(c: str):
        nothing = F.lit(None).cast(kinds[c])
        from_old = F.col(f"_o_{c}") if c in old.columns else nothing
        from_new = F.col(f"_n_{c}") if c in new.columns else nothing
        if c in replaced and c in new.columns:
            return F.when(F.col("_in_n"), from_new).otherwise(from_old)
        return F.when(F.col("_in_o"), from_old).otherwise(from_new)

    return joined.select(*key, *[value(c).cast(kinds[c]).alias(c) for c in others])
