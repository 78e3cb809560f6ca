"""Every named query against its SQL twin, and assertions on physical plans."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from orderloom.plans.queries import QUERIES
from orderloom.schemas import ORDERS, STATUS_HISTORY
from orderloom.sources import store
from orderloom.sources.marketplace import Marketplace
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    difference, rows = compare(spark, connection, FOLDER, name)
    assert difference is None
    assert rows > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry(spark).columns == ["category", "seller_id", "revenue"]


@pytest.mark.parametrize("name", [q for q in QUERIES if q != "load_tables"])
def test_plans_stay_native(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_scans_read_only_needed_columns(spark):
    scans = ("scan_orders", "scan_items", "scan_listings", "scan_history")
    plan = "".join(plan_of(queries()[name](spark, FOLDER)) for name in scans)
    for unread in ("p_retailprice", "p_size", "o_totalprice", "l_discount", "l_comment"):
        assert unread not in plan


def test_top_sellers_prunes_before_the_window_shuffle(spark):
    assert plan_of(queries()["top_sellers"](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_lookup_reaches_the_scans(spark):
    plan = plan_of(queries()["order_lookup"](spark, FOLDER))
    assert "EqualTo(o_orderkey,7)" in plan and "EqualTo(l_orderkey,7)" in plan


def test_status_layout_prunes_partitions(spark, tmp_path):
    m = Marketplace(spark, FOLDER)
    store.write_table(m.history, STATUS_HISTORY, str(tmp_path / "h"))
    df = spark.read.parquet(str(tmp_path / "h")).filter("order_status = 'SHIPPED'")
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\]", plan_of(df)).group(1)
    assert "order_status" in partition_filters and "SHIPPED" in partition_filters
    assert df.count() == m.history.filter("order_status = 'SHIPPED'").count()


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    """Looking up an absent odd id between even ones reads no row at all."""
    orders = spark.range(0, 1_000_000, 2, 1).selectExpr("id AS order_id", "'c1' AS customer_id")
    store.write_table(orders, ORDERS, str(tmp_path / "o"))
    found = spark.read.parquet(str(tmp_path / "o")).filter("order_id = 77777")
    assert found.collect() == []
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() == 0
