from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oreworks.config import FrameRules, RowRules
from oreworks.operators import checks
from oreworks.operators.validation import flag_payloads, flag_rows, split_rows, validate
from oreworks.schemas import TableContract
from oreworks.sinks.tables import quarantine, read_quarantine, read_valid, write_flagged

RULES = RowRules.from_rule_list(
    [{"type": "not_null", "columns": ["id", "name"]}, {"type": "not_null", "columns": ["id"]}]
)


def priced(spark):
    rows = [
        ("a", "A", 0.0, 1, 1),
        ("b", "B", 1e6, 1, 1),
        ("c", "C", 1e6 + 1, 1, 1),
        ("d", "D", -1.0, 1, 1),
        ("e", "E", None, None, None),
        ("f", "F", 1.0, -1, -1),
        (None, None, 1.0, 1, 1),
    ]
    return spark.createDataFrame(
        rows, "id string, name string, current_price double, market_cap long, total_volume long"
    )


def test_row_codes(spark):
    flagged = flag_rows(priced(spark), RULES).orderBy(F.col("id").asc_nulls_last())
    codes = [list(r.validation_errors) for r in flagged.collect()]
    assert codes == [
        [],
        [],
        ["current_price_out_of_range"],
        ["current_price_out_of_range"],
        [],
        ["market_cap_negative", "total_volume_negative"],
        ["id_is_null", "name_is_null"],
    ]
    valid, invalid = split_rows(flagged)
    assert valid.count() == 3 and invalid.count() == 4
    assert valid.columns == priced(spark).columns
    assert validate(priced(spark), RULES)[1].count() == 4


def test_config_rules(spark):
    block = {
        "required_fields": ["id"],
        "numeric_fields": ["current_price"],
        "min_price": 0.0000001,
        "max_price": 1000000000,
    }
    df = spark.createDataFrame(
        [("a", "0"), ("b", "x"), ("c", "12"), (None, None)], "id string, current_price string"
    )
    flagged = flag_rows(df, RowRules.from_config(block)).orderBy(F.col("id").asc_nulls_last())
    assert [list(r.validation_errors) for r in flagged.collect()] == [
        ["current_price_out_of_range"],
        ["current_price_not_numeric"],
        [],
        ["id_is_null"],
    ]


def test_one_write_keeps_both_halves(spark, folder):
    counts = write_flagged(flag_rows(priced(spark), RULES), folder)
    assert counts == {"valid": 3, "invalid": 4}
    assert read_valid(spark, folder).count() == 3
    rejected = read_quarantine(spark, folder)
    assert rejected.filter(F.size("validation_errors") == 0).count() == 0
    plan = read_valid(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_valid" in plan


def test_quarantine_repeats_without_duplicates(spark, folder):
    _, invalid = validate(priced(spark), RULES)
    quarantine(invalid, folder, "r1")
    quarantine(invalid, folder, "r1")
    quarantine(invalid, folder, "r2")
    assert spark.read.parquet(folder).count() == 8


def test_required_payload_fields(spark):
    df = spark.createDataFrame(
        [('{"id": "a", "symbol": "s"}',), ('{"id": "b"}',), ('{"id": null, "symbol": "s"}',)],
        "t string",
    ).select(F.parse_json("t").alias("p"))
    flags = [r.is_valid for r in flag_payloads(df, "p", ["id", "symbol"]).collect()]
    assert flags == [True, False, False]


def report(df):
    return {(r.check, r.column_name, r.metric): r for r in df.collect()}


def test_completeness_is_strict(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 5, F.col("id")).alias("five"),
        F.when(F.col("id") >= 4, F.col("id")).alias("four"),
    )
    found = report(checks.quality_report(df, FrameRules(required=("five", "four", "none"))))
    assert found["completeness", "five", "null_percentage"].passed is False
    assert found["completeness", "four", "null_percentage"].passed is True
    assert found["completeness", "five", "null_count"].value == 5
    assert len(found) == 4


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a int")
    rules = FrameRules(required=("a",), unique=("a",), ranges={"a": (0, 1)})
    found = report(checks.quality_report(df, rules))
    assert found["completeness", "a", "null_percentage"].value == 0.0
    assert all(r.passed for r in found.values())
    assert found["uniqueness", "a", "total"].value == 0


def test_uniqueness_counts_null_once(spark):
    df = spark.createDataFrame([(1, -0.0), (2, 0.0), (None, 1.0), (None, None)], "a int, b double")
    found = report(checks.uniqueness_report(df, ["a", "b"]))
    assert found["uniqueness", "a", "distinct"].value == 3
    assert found["uniqueness", "a", "duplicates"].value == 1
    assert found["uniqueness", "b", "distinct"].value == 3  # the zeros are one value


def test_uniqueness_of_all_columns_is_one_scan(spark, folder):
    rows = [(i % 3, "x" if i % 2 else None, [i % 5], {"k": i % 4}) for i in range(40)]
    df = spark.createDataFrame(rows, "a int, b string, c array<int>, d map<string,int>")
    df.write.parquet(folder)
    stored = spark.read.parquet(folder)
    found = checks.uniqueness_report(stored, ["a", "b", "c", "d", "a"])
    distinct = {r.column_name: r.value for r in found.filter("metric = 'distinct'").collect()}
    assert distinct == {"a": 3, "b": 2, "c": 5, "d": 4}
    assert {r.value for r in found.filter("metric = 'total'").collect()} == {40}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1 and plan.count("Expand") == 1


def test_uniqueness_of_more_columns_than_a_grouping_id_holds(spark):
    width = checks.COLUMNS_A_SCAN + 3
    df = spark.range(6).select(*[(F.col("id") % (1 + i % 6)).alias(f"c{i}") for i in range(width)])
    found = report(checks.uniqueness_report(df, df.columns))
    assert [found["uniqueness", f"c{i}", "distinct"].value for i in range(width)] == [
        1 + i % 6 for i in range(width)
    ]


def test_range_and_open_bounds(spark):
    df = spark.createDataFrame([(-1,), (0,), (10,), (11,), (None,)], "a int")
    outside = lambda bounds: report(
        checks.quality_report(df, FrameRules(ranges={"a": bounds}))
    )["range", "a", "out_of_range_count"]
    assert outside((0, 10)).value == 2 and outside((0, 10)).passed is False
    assert outside((None, 10)).value == 1
    assert outside((0, None)).value == 1
    assert outside((None, None)).passed is True


def test_freshness_limit_and_all_null(spark):
    at = datetime(2024, 1, 2)
    df = spark.createDataFrame([(at - timedelta(hours=24), None)], "t timestamp_ntz, u timestamp_ntz")
    rules = FrameRules(freshness="t")
    line = report(checks.quality_report(df, rules, at))["freshness", "t", "age_hours"]
    assert line.value == 24.0 and line.passed is True
    older = report(checks.quality_report(df, rules, at + timedelta(seconds=1)))
    assert older["freshness", "t", "age_hours"].passed is False
    assert checks.quality_report(df, FrameRules(freshness="u"), at).count() == 0
    with pytest.raises(ValueError):
        checks.quality_report(df, rules)


def test_folded_report(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    folded = checks.fold_report(checks.quality_report(df, FrameRules(("a",), unique=("a",))))
    assert folded["passed"] is False
    assert folded["checks"]["a_uniqueness"]["duplicates"] == 1
    assert folded["checks"]["a_completeness"]["passed"] is True


def test_validate_frame(spark):
    df = spark.createDataFrame([("a", None)], "id string, name string")
    found = report(checks.validate_frame(df, ["id", "price"], ["id", "name", "price"]))
    assert found["required", "price", "missing_column"].passed is False
    assert found["warning", "name", "null_count"].passed is True
    assert found["stats", "*", "total_columns"].value == 2
    assert ("warning", "id", "null_count") not in found
    with pytest.raises(ValueError):
        checks.validate_frame(df, ["price"], raise_on_error=True)


def test_validate_schema(spark):
    df = spark.createDataFrame([("1", 2), ("x", 3)], "a string, b long")
    rows = checks.validate_schema(
        df, {"a": "LongType()", "b": "LongType", "c": "string", "b2": "bigint"}
    )
    found = {r.column_name: r for r in rows.collect()}
    assert sorted(found) == ["a", "b2", "c"]
    assert (found["a"].issue, found["a"].rows, found["a"].castable_rows) == ("type_mismatch", 2, 1)
    assert found["c"].issue == "missing" and found["c"].actual is None
    assert checks.validate_schema(df, {"a": "string", "b": "bigint"}).count() == 0
    # A part of a type name is no match.
    with pytest.raises(Exception):
        checks.validate_schema(df, {"a": "Type"}).collect()


def test_zscore_needs_enough_rows(spark):
    few = spark.createDataFrame([(v,) for v in (100, 105, 102, 98, 1000)], "value long")
    found = report(checks.zscore_report(few, ["value"], 2.0))
    assert found["zscore", "value", "anomaly_count"].value == 0  # at most 1.789 for five rows
    many = spark.createDataFrame(
        [(v, 1, "t") for v in [100] * 11 + [1000]], "value long, same int, text string"
    )
    found = report(checks.zscore_report(many, ["value", "same", "text", "none"], 3.0))
    assert found["zscore", "value", "anomaly_count"].value == 1
    assert {k[1] for k in found} == {"value"}
    examples = checks.zscore_examples(many, ["value", "same"], ["value"]).collect()
    assert [(r.column_name, r.anomaly_value, r.position) for r in examples] == [("value", 1000.0, 1)]


def test_zscore_examples_stop_at_ten(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 20, 1e6).otherwise(1.0).alias("v"))
    examples = checks.zscore_examples(df, ["v"], ["id"]).orderBy("position").collect()
    assert [r.id for r in examples] == list(range(10))


def test_contracts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    contract = TableContract(not_null=("k", "v"), key=("k", "v"))
    found = report(checks.contract_nulls(df, contract))
    assert found["not_null", "k", "null_count"].value == 1
    assert found["not_null", "v", "null_count"].passed is True
    broken = checks.contract_key_violations(df, contract.key).collect()
    assert [(r.k, r.v, r.row_count) for r in broken] == [("a", 1, 2)]


def test_report_is_one_scan(spark, folder):
    spark.range(10).selectExpr("id a", "id b", "id c").write.parquet(folder)
    df = spark.read.parquet(folder)
    rules = FrameRules(required=("a", "b"), ranges={"a": (0, 5)}, max_null_pct=1.0)
    plan = checks.quality_report(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan
