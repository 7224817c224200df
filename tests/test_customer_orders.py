"""The kept order history of the customers against the rollup over all lines."""

import re

import pytest
from pyspark.sql import functions as F

from silverlode.config import Settings
from silverlode.plans import conform, dimensions
from silverlode.plans.customer_orders import OrderHistory
from silverlode.plans.silver_sales import TABLE, SalesStore
from silverlode.session import scratch_path
from silverlode.sources import bronze

COLUMNS = "sls_ord_num string, sls_prd_key string, sls_cust_id string, sls_order_dt string, sls_ship_dt string, sls_due_dt string, sls_sales string, sls_quantity string, sls_price string"


class World:
    def __init__(self, spark):
        self.spark, self.settings = spark, Settings(root=scratch_path(spark, "test-history"))
        self.store = SalesStore(spark, self.settings)
        self.history = OrderHistory(spark, self.settings, self.store)
        self.price("3.00")

    def price(self, cost):
        # The second product has no known cost.
        self.lookup = self.spark.sql(f"select 'BK-1' as product_key, cast('{cost}' as decimal(18,2)) as product_cost union all select 'BK-2', null")

    def deliver(self, batch, *lines, mode="append"):
        rows = [(order, item, buyer, day, day, day, "10", "2", "5") for order, item, buyer, day in lines]
        spec = next(s for s in bronze.sources() if s.table == TABLE)
        frame = self.spark.createDataFrame(rows, COLUMNS).withColumn("_source_file", F.lit("f.csv"))
        bronze.write_bronze(bronze.with_lineage(frame, spec, batch), self.settings.layer("bronze"), TABLE, mode)

    def refresh(self, **options):
        self.store.refresh()
        return [name.split("@")[0] for name in self.history.refresh(self.lookup, **options)]

    def check(self):
        """The kept history equals the rollup of every line, types included; returns orders by customer."""
        kept = self.history.read(self.lookup)
        whole = dimensions.order_rollup(conform.price_sales(self.store.read(), self.lookup)).filter("customer_id is not null")
        assert [(f.name, f.dataType) for f in kept.select(*whole.columns).schema] == [(f.name, f.dataType) for f in whole.schema]
        assert sorted(map(str, kept.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
        return {r.customer_id: r.order_count for r in kept.collect()}


@pytest.fixture
def world(spark):
    return World(spark)


FIRST = (("so1", "bk-1", "7", "20140105"), ("so1", "bk-2", "7", "20140105"), ("so2", "bk-1", "8", "20140106"), ("so5", "bk-2", "9", "20140101"))
SECOND = (("so1", "bk-1", "8", "20140109"), ("so2", "bk-2", "8", "20130106"), ("so3", "bk-1", "7", "20140107"), ("so3", "bk-9", "7", "20140107"))


def test_new_batches_are_added_and_old_lines_not_read(world, monkeypatch):
    world.deliver("b1", *FIRST)
    assert world.refresh() == ["b1"] and world.check() == {7: 1, 8: 1, 9: 1}
    read = []
    monkeypatch.setattr(world.store, "lines", lambda batches: read.extend(batches) or SalesStore.lines(world.store, batches))
    # An order over two batches, a number that two customers share, an unknown product, an older day.
    world.deliver("b2", *SECOND)
    assert world.refresh() == ["b2"]
    assert [name.split("@")[0] for name in read] == ["b2"]
    lines = SalesStore.lines(world.store, read)
    text = lines._sc._jvm.PythonSQLUtils.explainString(lines._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[.*regexp_replace\(_batch#\d+, @.*\) = b2@", text)
    assert world.check() == {7: 2, 8: 2, 9: 1}
    before = world.history.totals.version()
    assert world.refresh() == [] and world.history.totals.version() == before


def test_several_batches_at_once_and_rows_without_ids(world):
    world.deliver("b1", *FIRST, ("so9", "bk-1", "", "20140101"), ("so9", "bk-1", "x", "20140101"))
    world.deliver("b2", *SECOND, *FIRST)
    assert world.refresh() == ["b1", "b2"] and world.check() == {7: 2, 8: 2, 9: 1}


def test_rewritten_and_lost_batches(world):
    world.deliver("b1", *FIRST)
    world.deliver("b2", *SECOND)
    world.refresh()
    world.deliver("b1", FIRST[0])
    assert world.refresh() == ["b1", "b2"] and world.check() == {7: 2, 8: 2}
    world.deliver("b3", FIRST[2], mode="overwrite")
    assert world.refresh() == ["b3"] and world.check() == {8: 1}


def test_changed_costs_change_old_margins(world):
    world.deliver("b1", *FIRST)
    world.refresh()
    world.price("4.00")
    assert world.refresh() == ["b1"]
    world.check()
    assert world.refresh() == [] and world.refresh(full=True) == ["b1"]
    world.check()


def test_a_run_that_dies_between_the_tables_is_repeated(world, monkeypatch):
    world.deliver("b1", *FIRST)
    world.refresh()
    world.deliver("b2", *SECOND)

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(world.history.totals, "replace_partitions", die)
        with pytest.raises(RuntimeError):
            world.refresh()
    assert world.refresh() == ["b2"] and world.check() == {7: 2, 8: 2, 9: 1}


def test_nothing_stored(world):
    assert world.refresh() == []
    world.deliver("b1", ("so1", "bk-1", "7", "bad"))
    assert world.refresh() == [] and world.check() == {}
