"""Registered queries on copies of the tables in which one key holds a third of the rows."""

from pathlib import Path

import duckdb
import pytest
from compare import TABLES, connect, differences

from oreworks.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
THIRD = {
    "lineitem": "CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey",
    "events": """CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-11' + INTERVAL (event_id) SECOND
             ELSE ts END AS ts""",
    "orders": """CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1998-10-03'
        ELSE o_orderdate END AS o_orderdate""",
    "documents": """CASE WHEN doc_id % 3 = 0 THEN 'copy' ELSE text END AS text,
        CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS lang""",
}
NAMES = (
    "bronze_extraction_stats",
    "contract_pk",
    "dedup_rows",
    "dq_uniqueness",
    "event_spikes",
    "gold_by_category",
    "latest_per_user",
    "mark_processed",
    "market_dominance",
    "order_value_rank",
    "scd2_merge",
    "select_by_ids",
    "volatility_analysis",
)

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        replaced = f"REPLACE ({THIRD[name]})" if name in THIRD else ""
        con.execute(
            f"COPY (SELECT * {replaced} FROM '{SF}/{name}.parquet') "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, skewed_dir, name):
    assert differences(QUERIES[name](spark, skewed_dir), connect(skewed_dir), ORACLES[name]) == []
