"""Order history per customer, kept between builds: a build adds what new batches bring and reads no old sales line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.config import Settings
from silverlode.operators.versioned import VersionedTable, in_shape
from silverlode.plans import conform, dimensions
from silverlode.plans.silver_sales import SIGNED, SalesStore
from silverlode.session import stash

_PART = "_part"
_ORDER = ("customer_id", "order_number")


class OrderHistory:
    """Two versioned tables with one partition per signed batch and signature of the product costs.

    * ``totals``: a row per customer and batch. Counts, sums, first and last day can be merged as they are.
    * ``orders``: every order of a customer, in the first batch that has it. An order may reach over batches, so
      ``totals`` counts those of a batch that are in no other one; the count over all batches is then a sum.

    New orders are compared with stored ones inside the range of their numbers only, which reaches the Parquet
    statistics. Margins follow from today's product costs: where these change, or where a batch was rewritten
    or is gone, everything is derived anew from the stored lines. ``totals`` is written last; a run that fails in
    between is repeated with the same result.
    """

    def __init__(self, spark: SparkSession, settings: Settings, sales: SalesStore):
        self.spark, self.sales = spark, sales
        silver = settings.layer("silver")
        self.totals = VersionedTable(spark, f"{silver}/customer_totals", "customer_id", _PART)
        self.orders = VersionedTable(spark, f"{silver}/customer_orders", "order_number", _PART)

    def refresh(self, lookup: DataFrame, full: bool = False) -> list[str]:
        """Bring both tables up to the sales store; returns the signed batches whose lines were read."""
        mark = _cost_signature(lookup)
        wanted = {f"{batch}@{mark}": batch for batch in self.sales.batches()}
        done = set(self.totals.partitions())
        stale = (done | set(self.orders.partitions())) - set(wanted)
        anew = full or bool(stale) or not done
        fresh = sorted(set(wanted) if anew else set(wanted) - done)
        if fresh or stale:
            self._fold(fresh, [wanted[part] for part in fresh], lookup, mark, anew)
        return [wanted[part] for part in fresh]

    def _fold(self, fresh: list[str], batches: list[str], lookup: DataFrame, mark: str, anew: bool) -> None:
        lines = conform.price_sales(self.sales.lines(batches), lookup).filter(F.col("customer_id").isNotNull())
        place = F.concat_ws("@", SIGNED, F.lit(mark))
        by_order = lines.withColumn(_PART, place).groupBy(_PART, *_ORDER).agg(
            F.count(F.lit(1)).alias("order_line_count"),
            F.sum("quantity").alias("total_units"),
            F.sum("sales_amount").alias("lifetime_sales_amount"),
            F.sum("gross_margin").alias("lifetime_gross_margin"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        # Read for the orders, their range and the totals.
        by_order = stash(by_order, "orders-of-batches")
        first = by_order.filter(F.col("order_number").isNotNull()).groupBy(*_ORDER).agg(F.min(_PART).alias(_PART))
        if anew:
            self.orders.overwrite(first, ("order_number",))
        else:
            self.orders.replace_partitions(self._unseen(first, by_order, fresh), sort=("order_number",))
        known = self.orders.read()
        counted = (by_order.limit(0) if known is None else known.filter(F.col(_PART).isin(*fresh))).groupBy(
            _PART, "customer_id"
        ).agg(F.count(F.lit(1)).alias("order_count"))
        merged = merge_totals(by_order, _PART, "customer_id").join(counted, [_PART, "customer_id"], "left")
        merged = merged.withColumn("order_count", F.coalesce("order_count", F.lit(0)))
        if anew:
            self.totals.overwrite(merged, ("customer_id",))
        else:
            self.totals.replace_partitions(merged, sort=("customer_id",))

    def _unseen(self, first: DataFrame, by_order: DataFrame, fresh: list[str]) -> DataFrame:
        """Orders that no other stored batch has."""
        low, high = by_order.agg(F.min("order_number"), F.max("order_number")).first()
        known = self.orders.read()
        if low is None or known is None:
            return first
        near = known.filter(F.col("order_number").between(low, high) & ~F.col(_PART).isin(*fresh))
        return first.join(near.select(*_ORDER), list(_ORDER), "left_anti")

    def read(self, lookup: DataFrame) -> DataFrame:
        """One row per customer with orders, in the columns and types of ``dimensions.order_rollup``."""
        shape = dimensions.order_rollup(conform.price_sales(self.sales.read(), lookup)).schema
        stored = self.totals.read()
        if stored is None:
            return self.spark.createDataFrame([], shape)
        count = F.sum("order_count").alias("order_count")
        return in_shape(merge_totals(stored, "customer_id", also=(count,)), shape)


def merge_totals(rows: DataFrame, *keys: str, also=()) -> DataFrame:
    """Totals of parts added up by ``keys``."""
    sums = ("order_line_count", "total_units", "lifetime_sales_amount", "lifetime_gross_margin")
    return rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        *also,
    )


def _cost_signature(lookup: DataFrame) -> str:
    """Changes when a product comes, goes or has another cost. Product keys are unique in a lookup."""
    mark = F.xxhash64("product_key", "product_cost")
    n, bits = lookup.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(mark), F.lit(0))).first()
    return f"{n:x}-{bits & 0xFFFFFFFFFFFFFFFF:016x}"
