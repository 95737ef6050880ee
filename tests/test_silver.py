from datetime import datetime

from pyspark.sql import functions as F

from oreworks.operators.anomalies import (
    anomalous_rows,
    detect_anomalies,
    flag_price_anomalies,
    flag_volume_spikes,
)
from oreworks.operators.silver import (
    basic_clean,
    cast_if_present,
    derive_metrics,
    nan_to_null,
    project_silver,
    to_silver,
    zero_as_null,
)
from oreworks.schemas import BRONZE_SCHEMA

RUN = datetime(2024, 1, 2, 3, 4, 5)


def bronze(spark, *rows):
    """Bronze records with the given fields, all others null."""
    full = [tuple(r.get(f.name) for f in BRONZE_SCHEMA) for r in rows]
    nullable = BRONZE_SCHEMA.json().replace('"nullable":false', '"nullable":true')
    from pyspark.sql.types import StructType, _parse_datatype_json_string

    schema = _parse_datatype_json_string(nullable)
    assert isinstance(schema, StructType)
    return spark.createDataFrame(full, schema)


def test_silver_columns_and_values(spark):
    record = dict(
        id="bitcoin", symbol="btc", name="Bitcoin", current_price=45000.0, market_cap=850 * 10**9,
        total_volume=25 * 10**9, high_24h=46000.0, low_24h=44000.0, circulating_supply=19.0,
        max_supply=21.0, ath=69000.0, ath_date="2021-11-10T14:24:11.849Z", atl=67.81,
        atl_date="x", last_updated="2024-01-01T00:00:00Z", extracted_at="2024-01-01T00:01:00Z",
    )
    row = to_silver(bronze(spark, record), RUN).first()
    assert row.coin_id == "bitcoin" and row.market_cap_category == "Large Cap"
    assert abs(row.price_volatility_24h - 2000 / 44000 * 100) < 1e-9
    assert abs(row.supply_percentage - 19 / 21 * 100) < 1e-9
    assert abs(row.distance_from_ath_pct - 24000 / 69000 * 100) < 1e-9
    assert row.ath_date == datetime(2021, 11, 10, 14, 24, 11, 849000) and row.atl_date is None
    assert row.updated_at == row.silver_processed_at == RUN
    assert len(project_silver(bronze(spark, record)).columns) == 22


def test_zero_divisors_give_null(spark):
    zero = dict(id="z", current_price=1.0, market_cap=0, total_volume=5, high_24h=1.0, low_24h=0.0,
                circulating_supply=1.0, max_supply=0.0, ath=0.0, atl=0.0)
    row = to_silver(bronze(spark, zero), RUN).first()
    for c in ("price_volatility_24h", "volume_to_market_cap_ratio", "supply_percentage",
              "distance_from_ath_pct", "distance_from_atl_pct"):
        assert row[c] is None, c
    assert row.market_cap_category == "Small Cap"


def test_optional_feed_columns_are_kept(spark):
    df = bronze(spark, dict(id="a")).withColumn("run_id", F.lit("r1"))
    assert project_silver(df).columns[-1] == "run_id"


def test_clean_duplicates_nulls_and_nan(spark):
    rows = [("a", 1.0), ("a", 1.0), ("b", None), (None, 2.0), ("c", float("nan")), ("d", 0.0)]
    df = spark.createDataFrame(rows, "id string, current_price double")
    kept = sorted((r.id, r.current_price) for r in basic_clean(df).collect())
    assert kept == [("a", 1.0), ("d", 0.0)]
    assert nan_to_null(df).filter("id = 'c' AND current_price IS NULL").count() == 1


def test_cast_and_zero_as_null(spark):
    df = spark.createDataFrame([("1.5", "x", 0), ("0", "", 3)], "current_price string, t string, n int")
    cast = cast_if_present(df.withColumnRenamed("t", "market_cap"))
    assert [r.current_price for r in cast.collect()] == [1.5, 0.0]
    assert [r.market_cap for r in cast.collect()] == [None, None]
    coerced = zero_as_null(df, ["t", "n"]).collect()
    assert [(r.t, r.n) for r in coerced] == [("x", None), (None, 3)]


def test_price_anomaly_limits(spark):
    df = spark.createDataFrame(
        [(50.0,), (50.1,), (-50.1,), (None,)], "price_change_percentage_24h double"
    )
    flags = [r.is_price_anomaly for r in flag_price_anomalies(df, 0.5).collect()]
    assert flags == [False, True, True, False]


def spike_rows(spark):
    """Groups of 10 and 12 equal values plus an extreme, a single row, a constant, a null group."""
    rows = []
    for group, n in (("ten", 9), ("twelve", 11)):
        rows += [(f"{group}{i}", group, 100) for i in range(n)] + [(f"{group}x", group, 10**6)]
    rows += [("s", "single", 5), *[(f"c{i}", "constant", 7) for i in range(12)]]
    rows += [(f"n{i}", None, 1) for i in range(20)] + [("nx", None, 10**6), ("null", "ten", None)]
    return spark.createDataFrame(rows, "coin_id string, market_cap_category string, total_volume long")


def test_volume_spikes_bounded_and_balanced_agree(spark):
    df = spike_rows(spark)
    for limit in (None, 5):
        flagged = flag_volume_spikes(df, group_limit=limit)
        assert flagged.columns == [*df.columns, "is_volume_spike"]
        assert flagged.count() == df.count()
        spikes = sorted(r.coin_id for r in flagged.filter("is_volume_spike").collect())
        assert spikes == ["nx", "twelvex"]  # a group of ten cannot reach three deviations
        assert flagged.filter("is_volume_spike IS NULL").count() == 0


def test_anomalous_rows(spark):
    df = spike_rows(spark).withColumn("price_change_percentage_24h", F.lit(60.0))
    flagged = detect_anomalies(df, 0.7, group_limit=5)
    assert sorted(r.coin_id for r in anomalous_rows(flagged).collect()) == ["nx", "twelvex"]


def test_derived_columns_take_one_projection(spark):
    plan = derive_metrics(bronze(spark, dict(id="a")))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Project") <= 1
