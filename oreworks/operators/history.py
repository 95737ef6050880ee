"""Type-2 history: close changed versions, open new ones."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oreworks.config import TRACKED_COLUMNS
from oreworks.functions import ts_literal

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current", "updated_at")


def latest_per_key(
    batch: DataFrame, key: Sequence[str], newest: Sequence[str] = ("last_updated", "extracted_at")
) -> DataFrame:
    """One row per key, the newest; equal times are settled by the remaining columns.

    Each task drops all but its best row of a key before the shuffle, so a key that repeats
    through much of the batch costs nothing extra.
    """
    unordered = (T.MapType, T.VariantType)
    rest = [
        f.name
        for f in batch.schema
        if f.name not in (*key, *newest) and not isinstance(f.dataType, unordered)
    ]
    order = [F.col(c).desc_nulls_last() for c in (*newest, *rest) if c in batch.columns]
    ranked = batch.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_nth = 1").drop("_nth")


def scd2_changes(
    current: DataFrame | None,
    batch: DataFrame,
    run_ts: datetime,
    key: Sequence[str] = ("coin_id",),
    tracked: Sequence[str] = TRACKED_COLUMNS,
    close_missing: bool = False,
) -> DataFrame:
    """All versions that result from a batch, each with a ``change``.

    ``carried``: open before and after; ``closed``: ended by this run; ``version``: replaces a
    closed one; ``new``: first version of a key. ``current`` holds at most one open version per key
    and ``batch`` at most one row per key (:func:`latest_per_key`). One full outer join on unique
    keys decides everything, so there is one shuffle per side and no hot key.
    """
    stamp = ts_literal(run_ts)
    key = list(key)
    batch = batch.drop(*VERSION_COLUMNS)
    opened = {
        "updated_at": stamp,
        "valid_from": stamp,
        "valid_to": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    }
    if current is None:
        return batch.withColumns(opened | {"change": F.lit("new")})

    kinds = {f.name: f.dataType for f in (*batch.schema.fields, *current.schema.fields)}
    columns = [c for c in kinds if c not in VERSION_COLUMNS]

    def packed(df: DataFrame, side: str) -> DataFrame:
        """Keys plus the whole row as one struct, missing columns as null."""
        have = set(df.columns)
        fields = [
            f"CAST({f'`{c}`' if c in have else 'NULL'} AS {kinds[c].simpleString()}) AS `{c}`"
            for c in columns
        ]
        fields += [c for c in VERSION_COLUMNS if c in have]
        keys = [f"`{k}` AS `{side}_{k}`" for k in key]
        return df.selectExpr(*keys, f"struct({', '.join(fields)}) AS {side}")

    same_key = " AND ".join(f"`old_{k}` = `new_{k}`" for k in key)
    joined = packed(current, "old").join(packed(batch, "new"), F.expr(same_key), "full_outer")

    changed = " OR ".join(f"NOT (old.`{c}` <=> new.`{c}`)" for c in tracked)
    closes = f"new IS NOT NULL AND ({changed})" + (" OR new IS NULL" if close_missing else "")
    at = f"TIMESTAMP_NTZ '{run_ts.isoformat(sep=' ')}'"

    def version(row: str, updated: str, start: str, end: str, is_open: str, change: str) -> str:
        values = [f"{row}.`{c}` AS `{c}`" for c in columns]
        values += [f"{updated} AS updated_at", f"{start} AS valid_from"]
        values += [f"CAST({end} AS TIMESTAMP_NTZ) AS valid_to", f"{is_open} AS is_current"]
        return f"struct({', '.join(values)}, {change} AS change)"

    ended = version("old", "old.updated_at", "old.valid_from", at, "false", "'closed'")
    carried = version("old", "old.updated_at", "old.valid_from", "NULL", "true", "'carried'")
    label = "if(old IS NULL, 'new', 'version')"
    opens = version("new", at, at, "NULL", "true", label)
    return joined.selectExpr(
        f"""inline(array(
            CASE WHEN old IS NOT NULL AND ({closes}) THEN {ended}
                 WHEN old IS NOT NULL THEN {carried} END,
            CASE WHEN new IS NOT NULL AND (old IS NULL OR {changed}) THEN {opens} END))"""
    ).filter("change IS NOT NULL")


def scd2_chain(
    current: DataFrame | None,
    batch: DataFrame,
    key: Sequence[str] = ("coin_id",),
    tracked: Sequence[str] = TRACKED_COLUMNS,
    time: str = "extracted_at",
    seen_to: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Like :func:`scd2_changes` for a batch that observed its keys at several times.

    Every observation that differs from the one before it opens a version at its own ``time``; of
    rows with the same key and time the newest counts. The open versions of ``current`` must not be
    later than the batch. A key has at most one row per time here, and tasks hold one row of it at
    a time. Neither key nor time may be null. ``seen_to`` names a column that gets the last time at
    which each key was observed, changed or not; ``current`` has it from the merge before.
    ``unique`` says that the batch has one row per key and time already, which saves a shuffle.
    """
    key = list(key)
    batch = batch.drop(*VERSION_COLUMNS)
    batch = batch if unique else latest_per_key(batch, [*key, time])
    stamps = {"valid_from": F.col(time), "updated_at": F.col(time), "_old": F.lit(False)}
    rows = batch.withColumns(stamps | ({seen_to: F.col(time)} if seen_to else {}))
    if current is not None:
        old = current.drop("valid_to", "is_current").withColumn("_old", F.lit(True))
        rows = rows.unionByName(old, allowMissingColumns=True)
    in_time = Window.partitionBy(*key).orderBy("valid_from", F.desc("_old"))
    state = F.struct(*tracked)
    seen = rows.withColumn("_before", F.lag(state).over(in_time))
    if seen_to:
        seen = seen.withColumn(seen_to, F.max(seen_to).over(Window.partitionBy(*key)))
    opens = F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before"))
    versions = seen.filter(opens).withColumn("valid_to", F.lead("valid_from").over(in_time))
    is_open = F.col("valid_to").isNull()
    change = (
        F.when(F.col("_old"), F.when(is_open, "carried").otherwise("closed"))
        .when(F.col("_before").isNull(), "new")
        .otherwise("version")
    )
    return versions.withColumns({"is_current": is_open, "change": change}).drop("_old", "_before")


def as_of_versions(versions: DataFrame, at: datetime) -> DataFrame:
    """The version of each key that was valid at a time."""
    t = ts_literal(at)
    return versions.filter(
        (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
    )
