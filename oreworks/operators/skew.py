"""Joins that stay balanced when one key holds a large share of the rows.

``balanced_join`` settles the few heavy keys by broadcast and joins the rest by key.
``salted_join`` suits a lookup that is tiny against the rows. ``attach_group_values`` adds
per-group figures to the rows of the group. Results are the same as those of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is heavy above 1/1000 of the rows, so fewer than 1000 keys can be heavy at once.
MAX_HEAVY_KEYS = 1000
DEFAULT_SALTS = 32


def _renamed(df: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in on})


def _match(on: Sequence[str], prefix: str, null_safe: bool) -> Column:
    met = None
    for c in on:
        left, right = F.col(c), F.col(f"{prefix}{c}")
        test = left.eqNullSafe(right) if null_safe else left == right
        met = test if met is None else met & test
    return met


def balanced_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    counts: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join rows to a lookup with one row per key.

    ``counts`` gives the rows per key as ``(*on, n)`` where the caller knows them; otherwise they
    are counted, which combines before the shuffle. Rows of heavy keys meet a broadcast of at most
    999 lookup rows and are not moved; the others are joined by key. Rows with a null key match
    nothing unless ``null_safe``, and take no part in the shuffle either. ``rows`` is read more
    than once, so pass a table, not a long derivation.
    ``how`` is one of inner, left, left_semi, left_anti.
    """
    on = list(on)
    if counts is None:
        counts = rows.groupBy(*on).agg(F.count("*").alias("n"))
    limit = rows.agg((F.count("*") / F.lit(MAX_HEAVY_KEYS)).alias("x")).scalar()
    heavy = F.broadcast(_renamed(counts.filter(F.col("n") > limit).select(*on), on, "_h_"))
    is_heavy = _match(on, "_h_", null_safe)
    keyed = _renamed(lookup, on, "_k_")
    names = [f"_k_{c}" for c in on]
    has_key = F.lit(True)
    if not null_safe:
        for c in on:
            has_key = has_key & F.col(c).isNotNull()

    heavy_lookup = _renamed(lookup.join(heavy, is_heavy, "left_semi"), on, "_k_")
    same = _match(on, "_k_", null_safe)
    parts = [
        rows.join(heavy, is_heavy, "left_semi").join(F.broadcast(heavy_lookup), same, how),
        rows.filter(has_key).join(heavy, is_heavy, "left_anti").join(keyed, same, how),
    ]
    if how in ("left", "left_anti") and not null_safe:
        loose = rows.filter(~has_key)
        if how == "left":
            added = [f for f in lookup.schema if f.name not in on]
            loose = loose.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
        parts.append(loose)
    joined = parts[0].drop(*names)
    for part in parts[1:]:
        joined = joined.unionByName(part.drop(*names))
    return joined


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[str],
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join rows to a lookup that is tiny against them, its keys used very unevenly.

    Each row takes a salt from a hash of ``spread_by`` (so a retried task gives the same salt) and
    the lookup is repeated once per salt. Spark still broadcasts it by itself when its measured
    size is under the session's limit. ``how`` is one of inner, left, left_semi, left_anti.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    spread = _renamed(lookup, on, "_k_").withColumn("_k_salt", copies)
    same = _match(on, "_k_", False) & (F.col("_salt") == F.col("_k_salt"))
    joined = rows.withColumn("_salt", salt).join(spread, same, how)
    return joined.drop("_salt", "_k_salt", *[f"_k_{c}" for c in on])


def attach_group_values(
    rows: DataFrame,
    groups: DataFrame,
    on: Sequence[str],
    group_limit: int | None = None,
) -> DataFrame:
    """Add per-group values to every row of the group, nulls forming a group of their own.

    ``group_limit`` is a proven upper limit of the number of groups (for example the number of
    size classes). With it the groups are broadcast and the rows are not moved at all. Without it
    ``groups`` should be a written table: Spark broadcasts it where its size is under the session's
    limit, and otherwise joins by key and splits the partitions of hot groups.
    """
    small = _renamed(groups, on, "_k_")
    if group_limit is not None:
        small = F.broadcast(small)
    joined = rows.join(small, _match(on, "_k_", True), "left")
    return joined.drop(*[f"_k_{c}" for c in on])
