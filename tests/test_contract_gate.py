"""Contracts where tables are written."""

from datetime import date

import pytest

from oreworks.schemas import GOLD_CONTRACT, TableContract
from oreworks.sinks.contract_gate import ContractColumnsError, _keys_in, flag_contract, keep_filled, write_checked

CONTRACT = TableContract(not_null=("k", "name"), key=("k", "day"), partition_by=("day",), cluster_by=("k",))
SCHEMA = "k long, day date, name string, n int, note string"
DAY = date(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def read(spark, path):
    return sorted((r.k, r.n) for r in spark.read.parquet(path).collect())


def reasons(spark, path, run):
    found = spark.read.parquet(f"{path}/run_id={run}").collect()
    return sorted((r.k is None, r.k or 0, r.n, tuple(r.validation_errors)) for r in found)


def test_rows_that_break_the_contract_wait_in_quarantine(spark, folder):
    path, rejected = f"{folder}/t", f"{folder}/r"
    rows = frame(
        spark,
        (1, DAY, "a", 1, "x"), (1, DAY, "a", 3, "x"), (1, DAY, None, 9, "x"), (1, None, "a", 4, "x"),
        (2, DAY, "b", None, "x"), (2, DAY, "b", 5, "x"), (None, DAY, None, 6, "x"), (3, DAY, "", 7, None),
    )
    counts = write_checked(rows, CONTRACT, path, rejected, "one", newest=["n"])
    assert counts == {"valid": 4, "invalid": 4}
    assert read(spark, path) == [(1, 3), (1, 4), (2, 5), (3, 7)]
    assert reasons(spark, rejected, "one") == [
        (False, 1, 1, ("key_repeated",)), (False, 1, 9, ("name_is_null",)), (False, 2, None, ("key_repeated",)),
        (True, 0, 6, ("k_is_null", "name_is_null")),
    ]


def test_a_repeated_run_adds_nothing(spark, folder):
    path, rejected = f"{folder}/t", f"{folder}/r"
    rows = frame(spark, (1, DAY, "a", 1, "x"), (2, date(2024, 1, 2), "b", 2, "x"))
    write_checked(rows, CONTRACT, path, rejected, "one")
    more = rows.unionByName(frame(spark, (1, DAY, "a", 5, "x"), (3, DAY, "c", 3, "x")))
    assert write_checked(more, CONTRACT, path, rejected, "two") == {"valid": 1, "invalid": 3}
    assert read(spark, path) == [(1, 1), (2, 2), (3, 3)]
    assert ("key_repeated", "key_exists") in [r[3] for r in reasons(spark, rejected, "two")]
    # The run again with whole rows only: what it set aside before goes.
    assert write_checked(frame(spark, (4, DAY, "d", 4, "x")), CONTRACT, path, rejected, "two")["invalid"] == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        reasons(spark, rejected, "two")
    assert write_checked(rows.limit(0), CONTRACT, path, rejected, "three") == {"valid": 0, "invalid": 0}
    assert write_checked(more, CONTRACT, path, rejected, "four", mode="overwrite") == {"valid": 3, "invalid": 1}
    assert [k for k, _ in read(spark, path)] == [1, 2, 3]


def test_a_key_with_most_rows(spark):
    """One key holds nine tenths of the rows; one row of it stays, and none is lost."""
    rows = spark.range(20_000).selectExpr(
        "IF(id % 10 = 0, id, -1) AS k", "DATE'2024-01-01' AS day", "'a' AS name", "CAST(id % 7 AS INT) AS n", "'x' AS note"
    )
    flagged = flag_contract(rows, CONTRACT, newest=["n"])
    assert flagged.count() == 20_000
    kept = flagged.filter("is_valid")
    assert kept.count() == kept.select("k").distinct().count() == 2_001
    assert kept.filter("k = -1").first().n == 6


def test_only_partitions_of_the_batch_are_read(spark, folder):
    days = [(k, date(2024, 1, k), "a", k, "x") for k in range(1, 6)]
    write_checked(frame(spark, *days), CONTRACT, f"{folder}/t", f"{folder}/r", "one")
    held = _keys_in(frame(spark, days[2]), f"{folder}/t", CONTRACT)
    assert [r.k for r in held.collect()] == [3]
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan.split("PartitionFilters: [")[1]


def test_missing_columns_and_columns_of_the_writer(spark, folder):
    rows = frame(spark, (1, DAY, None, 1, "x"), (2, DAY, "b", 2, "x"))
    with pytest.raises(ContractColumnsError, match="metric_date"):
        flag_contract(rows, GOLD_CONTRACT)
    contract = TableContract(not_null=("name", "valid_from"), key=("k",))
    kept = keep_filled(rows, contract, folder, "one", later=("valid_from",))
    assert [r.k for r in kept.collect()] == [2]
    assert reasons(spark, folder, "one") == [(False, 1, 1, ("name_is_null",))]
