"""Rows meet the contract of their table before they are written; the others wait in quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.operators.validation import codes
from oreworks.schemas import TableContract
from oreworks.sinks.files import child_names, delete, exists, materialize, shared_dir
from oreworks.sinks.tables import quarantine, read_quarantine, read_valid, write_flagged, write_table

# Codes of rows whose key is held by another row of the batch, or by the table.
KEY_REPEATED = "key_repeated"
KEY_EXISTS = "key_exists"
_PLACE = "_place"


class ContractColumnsError(ValueError):
    """A frame lacks columns that the contract of its table names."""


def contract_nulls_in(contract: TableContract, later: Sequence[str] = ()) -> dict[str, Column]:
    """A test per column that must be filled; ``later`` are columns that the writer itself adds."""
    return {f"{c}_is_null": F.col(c).isNull() for c in contract.not_null if c not in later}


def flag_contract(
    rows: DataFrame,
    contract: TableContract,
    known_keys: DataFrame | None = None,
    newest: Sequence[str] = (),
) -> DataFrame:
    """Add ``validation_errors`` and ``is_valid`` by a contract.

    Of rows with the same key the one with the greatest ``newest`` stays, nulls last; equal ones
    stand as they were read first. Rows with an empty required column take no part in that. A key
    that ``known_keys`` (the key columns of the table) holds already fails for every row of it.
    Null parts of a key are equal to each other.

    Per key one place is kept, which combines before the shuffle, and only repeated and known keys
    meet the rows again: a key of any number of rows gathers in no task.
    """
    return _flagged(_staged(rows, contract), contract, known_keys, newest)


def _staged(rows: DataFrame, contract: TableContract) -> DataFrame:
    """The rows as a table. Their numbers are written with them, so a repeated task reads the same."""
    wanted = dict.fromkeys([*contract.not_null, *contract.key])
    missing = [c for c in wanted if c not in rows.columns]
    if missing:
        raise ContractColumnsError(f"the contract needs {', '.join(missing)}")
    return materialize(rows.withColumn(_PLACE, F.monotonically_increasing_id()), "gate")


def _flagged(
    staged: DataFrame, contract: TableContract, known_keys: DataFrame | None, newest: Sequence[str]
) -> DataFrame:
    nulls = contract_nulls_in(contract)
    key = list(contract.key)
    filled = staged
    for test in nulls.values():
        filled = filled.filter(~test)
    best = F.max(F.struct(*newest, (-F.col(_PLACE)).alias(_PLACE)))[_PLACE]
    repeated = filled.groupBy(*key).agg((-best).alias("_first"), F.count("*").alias("_rows"))
    flagged = _met(staged, repeated.filter("_rows > 1").drop("_rows"), key, "_first")
    tests = dict(nulls)
    complete = F.lit(True)
    for test in nulls.values():
        complete = complete & ~test
    tests[KEY_REPEATED] = complete & F.col("_first").isNotNull() & (F.col("_first") != F.col(_PLACE))
    if known_keys is not None:
        known = known_keys.select(*key).distinct().withColumn("_known", F.lit(True))
        flagged = _met(flagged, known, key, "_known")
        tests[KEY_EXISTS] = complete & F.col("_known").isNotNull()
    errors = flagged.withColumn("validation_errors", codes(tests))
    own = [c for c in staged.columns if c != _PLACE]
    return errors.select(*own, "validation_errors", (F.size("validation_errors") == 0).alias("is_valid"))


def _met(rows: DataFrame, lookup: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Rows with a value per key, where there is one."""
    renamed = lookup.withColumnsRenamed({c: f"_k_{c}" for c in key})
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return rows.join(renamed.select(*[f"_k_{c}" for c in key], value), same, "left").drop(*[f"_k_{c}" for c in key])


def _keys_in(rows: DataFrame, path: str, contract: TableContract) -> DataFrame | None:
    """Keys of the table that the rows could meet, from the partitions that the rows go to.

    Of partition columns in the key the batch's values come to the driver, one per folder that the
    write touches anyhow.
    """
    spark = rows.sparkSession
    if not any(not n.startswith(("_", ".")) for n in child_names(spark, path)):
        return None
    key = list(contract.key)
    kinds = {f.name: f.dataType for f in rows.schema}
    held = spark.read.parquet(path).select(*[F.col(c).cast(kinds[c]).alias(c) for c in key])
    for c in contract.partition_by:
        if c in key:
            held = held.filter(F.col(c).isin([r[0] for r in rows.select(c).distinct().collect() if r[0] is not None]))
    return held.join(rows.select(*key).distinct(), key, "left_semi")


def write_checked(
    rows: DataFrame,
    contract: TableContract,
    path: str,
    rejected: str,
    run_id: str,
    newest: Sequence[str] = (),
    mode: str = "append",
) -> dict[str, int]:
    """Write the rows that keep the contract, and the others with their reasons under their run.

    Returns ``valid`` and ``invalid`` counts. An append also keeps keys apart from those of the
    table, so a repeated run adds nothing a second time; an overwrite looks at its own rows alone.
    Partitions and order are the contract's. Keys that are null in part never meet the table's.
    """
    spark = rows.sparkSession
    rows = _staged(rows, contract)
    known = _keys_in(rows, path, contract) if mode == "append" else None
    flagged = _flagged(rows, contract, known, newest)
    gated = shared_dir(spark, "gated")
    counts = write_flagged(flagged, gated)
    if counts["valid"]:
        valid = read_valid(spark, gated, flagged.schema)
        write_table(valid, path, mode, contract.partition_by, contract.cluster_by)
    _set_aside(spark, gated, counts["invalid"], rejected, run_id)
    return counts


def keep_filled(
    rows: DataFrame, contract: TableContract, rejected: str, run_id: str, later: Sequence[str] = ()
) -> DataFrame:
    """Rows with all required columns, for writers that settle keys themselves (merge, upsert).

    The others go to quarantine under their run. ``later`` are columns that the writer adds. One pass
    writes both; the kept rows are read from there.
    """
    spark = rows.sparkSession
    staged = shared_dir(spark, "filled")
    errors = codes(contract_nulls_in(contract, later))
    flagged = rows.withColumn("validation_errors", errors).withColumn("is_valid", F.size("validation_errors") == 0)
    counts = write_flagged(flagged, staged)
    _set_aside(spark, staged, counts["invalid"], rejected, run_id)
    return read_valid(spark, staged, flagged.schema)


def _set_aside(spark, staged: str, invalid: int, rejected: str, run_id: str) -> None:
    """The invalid rows of a run; a repeated run without any removes those of before."""
    if invalid:
        quarantine(read_quarantine(spark, staged).drop("is_valid"), rejected, run_id)
    elif exists(spark, f"{rejected}/run_id={run_id}"):
        delete(spark, f"{rejected}/run_id={run_id}")
