"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as registry
from silverlode.registry.spark_queries import QUERIES, clean, fact_frame

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, registry.oracle_sql()[name]) is None


def test_entry(spark):
    months = registry.entry(spark)
    assert months.columns[0] == "order_year_month" and months.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products_and_no_python(spark):
    text = plan(fact_frame(spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert bad not in text


def test_sales_lines_are_joined_twice_only(spark):
    """Once to the products, once to the customers; the rest is joined on the small sides."""
    import re

    text = plan(fact_frame(spark, SF))
    keys = re.findall(r"SortMergeJoin \[(\w+?)#\d+", text) + re.findall(r"BroadcastHashJoin \[(\w+?)#\d+", text)
    assert keys.count("customer_id") == 1


def test_scans_read_only_what_they_need(spark):
    text = plan(clean(spark, SF).sales.select("order_number", "sales_amount"))
    assert "o_totalprice" not in text and "l_extendedprice" not in text


def test_monthly_kpis_aggregate_by_hash(spark):
    from silverlode.plans import marts

    text = plan(marts.kpi_monthly(fact_frame(spark, SF)))
    assert "SortAggregate(key=[order_year_month" not in text
    text = plan(marts.category_sums(fact_frame(spark, SF)))
    assert "HashAggregate(keys=[category_id" in text
