"""The sales fact: full refresh, incremental refresh, staleness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.calendar import calendar_attributes, year_month
from silverlode.operators.versioned import VersionedTable, lookback
from silverlode.plans.conform import enrich_sales

FACT_KEY = "sales_line_id"
FACT_PARTITION = "order_year_month"
# Inside a month by date, then by line: both leave narrow min/max ranges per row group.
FACT_SORT = ("order_date", FACT_KEY)

# Output columns.
_AFTER_CALENDAR = (
    "ship_date",
    "due_date",
    "days_to_ship",
    "days_to_due",
    "days_in_transit",
    "sales_amount",
    "quantity",
    "unit_price",
    "discount_amount",
    "realised_unit_price",
    "product_cost",
    "gross_margin",
    "gross_margin_pct",
    "unit_margin_pct",
    "product_name",
    "product_line",
    "product_version_count",
    "category_id",
    "category_name",
    "subcategory_name",
    "requires_maintenance",
    "customer_name",
    "customer_gender",
    "customer_marital_status",
    "customer_age_band",
    "customer_country",
    "bronze_ingested_at",
)


def fact_rows(enriched: DataFrame) -> DataFrame:
    """Fact rows from enriched lines that already carry both surrogate keys, and their month if they are gathered by it."""
    calendar = calendar_attributes("order_date", "order")
    if "_month" in enriched.columns:
        # The column itself, so that Spark sees that the rows are sorted by it.
        calendar[FACT_PARTITION] = F.col("_month")
    return enriched.select(
        "sales_line_id",
        "order_number",
        "customer_sk",
        "customer_id",
        "customer_key",
        "product_sk",
        "product_key",
        "product_version_id",
        "order_date",
        *[c.alias(n) for n, c in calendar.items()],
        *_AFTER_CALENDAR,
    )


def build_fact(
    enriched: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    sides: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Fact rows from enriched lines and stored dimensions.

    A line that matches no dimension row keeps its measures and gets a null key. Only the current
    product version is joined, so the lines never multiply. Where the dimensions are derived in the
    same run, ``enrich_sales`` with key-carrying lookups and ``fact_rows`` give the same rows with
    two exchanges of the sales lines less.

    With ``sides`` (conformed customers and a ``product_lookup``) the lines are bare ones, enriched here: the keys are
    then looked up for the rows of the two sides, and the lines are joined twice instead of four times. The customer
    dimension must have the conformed customers.
    """
    people = dim_customers.select(
        F.col("customer_id").alias("_id"), F.col("customer_key").alias("_key"), "customer_sk"
    )
    items = dim_products.filter("is_current").select("product_key", "product_sk")
    if sides is not None:
        customers, products = (side.drop("customer_sk", "product_sk", "product_valid_from") for side in sides)
        known = people.drop("_key").withColumnRenamed("_id", "customer_id")
        buyers = customers.join(known, "customer_id", "left")
        return fact_rows(enrich_sales(enriched, buyers, products.join(items, "product_key", "left")))
    bare = enriched.drop("customer_sk", "product_sk")
    resolved = bare.join(items, "product_key", "left").join(
        people, F.col("customer_id") == F.col("_id"), "left"
    )
    return fact_rows(
        resolved.withColumns({"customer_id": F.col("_id"), "customer_key": F.col("_key")})
    )


def fact_table(spark: SparkSession, path: str, repeats: bool = False) -> VersionedTable:
    """The stored fact: keyed by sales line, partitioned by order month.

    With ``repeats`` a line id may occur more than once, as two products of an order may share a key: every line
    stays, in a refresh as in a full build.
    """
    return VersionedTable(spark, path, FACT_KEY, FACT_PARTITION, repeats)


def refresh_fact(
    table: VersionedTable, rows: DataFrame, days: int, full: bool = False, placed: bool = False
) -> int:
    """Write the fact; returns the new version.

    Full: exactly ``rows``. Otherwise the rows from ``days`` before the stored newest order date on
    are upserted: late and restated orders in that window are corrected, older ones and deletions
    wait for a full refresh. ``placed`` as in ``VersionedTable.overwrite``.
    """
    if full or table.version() is None:
        return table.overwrite(rows, sort=FACT_SORT, placed=placed)
    return table.upsert(lookback(rows, table.read(), "order_date", days), sort=FACT_SORT)


def lookback_start(table: VersionedTable, days: int) -> dt.date | None:
    """First day of the lookback window of the stored fact; None when nothing is stored, so all rows count."""
    stored = table.read()
    newest = None if stored is None else stored.agg(F.max("order_date")).first()[0]
    return None if newest is None else newest - dt.timedelta(days=days)


def replace_recent(table: VersionedTable, rows: DataFrame, since, placed: bool = False) -> int:
    """Delete-aware refresh: the fact from ``since`` on becomes exactly the rows from ``since`` on. ``placed`` as in
    ``VersionedTable.overwrite``."""
    cut = F.lit(since).cast("date")
    return table.replace_window(
        rows.filter(F.col("order_date") >= cut),
        in_window=F.col("order_date") >= cut,
        window_parts=F.col(FACT_PARTITION) >= year_month(cut),
        sort=FACT_SORT,
        placed=placed,
    )
