"""The store of cleaned sales lines: each bronze batch is parsed once, and refreshes read what changed."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from silverlode.config import Settings
from silverlode.plans import fact
from silverlode.plans.silver_sales import TABLE, SalesStore
from silverlode.session import scratch_path
from silverlode.sources import bronze

COLUMNS = "sls_ord_num string, sls_prd_key string, sls_cust_id string, sls_order_dt string, sls_ship_dt string, sls_due_dt string, sls_sales string, sls_quantity string, sls_price string"


@pytest.fixture
def lake(spark):
    settings = Settings(root=scratch_path(spark, "test-lake"))

    def deliver(batch, *lines, mode="append"):
        rows = [(f"so{n}", "bk-1", "7", day, day, day, str(amount), "1", "5") for n, day, amount in lines]
        spec = next(s for s in bronze.sources() if s.table == TABLE)
        frame = spark.createDataFrame(rows, COLUMNS).withColumn("_source_file", F.lit("f.csv"))
        bronze.write_bronze(bronze.with_lineage(frame, spec, batch), settings.layer("bronze"), TABLE, mode)

    return settings, deliver, SalesStore(spark, settings)


def amounts(store):
    return sorted((r.order_number, int(r.sales_amount), r.bronze_batch_id) for r in store.read().collect())


def test_each_batch_is_parsed_once(lake):
    _, deliver, store = lake
    deliver("b1", (1, "20140105", 10), (2, "bad", 20))
    assert [p.split("@")[0] for p in store.refresh()] == ["b1"]
    first = store.table.version()
    assert store.refresh() == [] and store.table.version() == first
    deliver("2014 b/2", (3, "20140106", 30))
    assert [p.split("@")[0] for p in store.refresh()] == ["2014 b/2"]
    assert amounts(store) == [("SO1", 10, "b1"), ("SO3", 30, "2014 b/2")]
    held = store.table._holders(store.table.version())
    assert sorted(held.values()) == [first, store.table.version()]


def test_a_replayed_batch_is_parsed_again_and_a_lost_one_goes(lake):
    _, deliver, store = lake
    deliver("b1", (1, "20140105", 10))
    deliver("b2", (2, "20140106", 20))
    store.refresh()
    deliver("b2", (2, "20140106", 21), (3, "20140107", 30))
    assert [p.split("@")[0] for p in store.refresh()] == ["b2"]
    assert amounts(store) == [("SO1", 10, "b1"), ("SO2", 21, "b2"), ("SO3", 30, "b2")]
    deliver("b3", (4, "20140108", 40), mode="overwrite")
    store.refresh()
    assert amounts(store) == [("SO4", 40, "b3")]


def test_a_failed_run_leaves_the_version_before(lake):
    _, deliver, store = lake
    deliver("b1", (1, "20140105", 10))
    fresh = {p: p.split("@")[0] for p in store.refresh()}
    store.table._write_rows(store.parsed(fresh), store.table._next(), ())  # dies before publishing
    assert amounts(store) == [("SO1", 10, "b1")] and store.refresh() == []


def test_only_new_folders_and_recent_files_are_read(lake):
    _, deliver, store = lake
    deliver("b1", *[(n, f"2014{1 + n % 12:02d}05", n + 1) for n in range(24)])
    store.refresh()
    deliver("b2", (90, "20141205", 9), (91, "20140101", 9))
    (name,) = [p for p in bronze.batch_signatures(store.spark, store.bronze, TABLE) if p == "b2"]
    files = store.parsed({"b2@x": name}).inputFiles()
    assert files and all("_batch_id=b2/" in f for f in files)
    fresh = store.refresh()
    recent = store.recent(dt.date(2014, 12, 1))
    explained = recent._sc._jvm.PythonSQLUtils.explainString(recent._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(order_date,2014-12-01)" in explained
    # The month in the folder names decides which folders are opened.
    assert re.search(r"PartitionFilters: \[.*substring_index\(_batch#\d+, @, -1\) >= 2014-12", explained)
    assert {r.order_number for r in store.recent(dt.date(2014, 12, 1)).collect()} == {"SO11", "SO23", "SO90"}
    assert "SO91" in {r.order_number for r in store.recent(dt.date(2014, 12, 1), fresh).collect()}


def test_lookback_start(spark, lake):
    settings, *_ = lake
    table = fact.fact_table(spark, f"{settings.layer('gold')}/fct_sales")
    assert fact.lookback_start(table, 3) is None
    table.overwrite(spark.sql("select 'a' as sales_line_id, date '2014-02-02' as order_date, '2014-02' as order_year_month"))
    assert fact.lookback_start(table, 3) == dt.date(2014, 1, 30)


def test_an_empty_store(lake):
    _, deliver, store = lake
    assert store.refresh() == []
    deliver("b1", (1, "bad", 10))
    store.refresh()
    assert store.read().count() == 0
