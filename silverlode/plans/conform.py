"""Customers, products and sales brought together across the source systems.

Order of the joins: everything that describes a product is joined on the product side first, so
the sales lines cross the network once per foreign key and not once per table. No side is forced into
a broadcast; Spark broadcasts what it measures to be small, and splits skewed sort-merge partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.calendar import age_band, as_of_date, days_between, full_years, month_count, year_month
from silverlode.functions.labels import preferred_gender
from silverlode.functions.measures import margin_measures
from silverlode.functions.text import dashed_key, hashed_key
from silverlode.operators.dedup import pick_version
from silverlode.plans.staging import sales_measures
from silverlode.session import stash


def conform_customers(
    customers: DataFrame, attributes: DataFrame, geography: DataFrame, as_of: dt.date | None
) -> DataFrame:
    """Every CRM customer, buyer or not, with ERP birth date, gender and country."""
    erp = attributes.select("customer_key", "birth_date", F.col("gender").alias("erp_gender"))
    today = as_of_date(as_of)
    joined = (
        customers.join(erp, "customer_key", "left")
        .join(geography.select("customer_key", "country"), "customer_key", "left")
        .withColumns(
            {
                "gender": preferred_gender("gender", "erp_gender"),
                "current_age": full_years("birth_date", today),
                "age_in_days": days_between("birth_date", today),
            }
        )
    )
    return joined.select(
        "customer_id",
        "customer_key",
        "customer_first_name",
        "customer_last_name",
        "customer_name",
        "marital_status",
        "gender",
        "birth_date",
        "country",
        "customer_created_date",
        "current_age",
        "age_in_days",
        age_band("birth_date", "current_age").alias("age_band"),
    )


def with_customer_sk(customers: DataFrame) -> DataFrame:
    return customers.withColumn("customer_sk", hashed_key("cust", "customer_key"))


def product_sk(valid_from: str) -> Column:
    """Surrogate key of a product version."""
    return hashed_key("prod", "product_key", valid_from)


def current_products(versions: DataFrame) -> DataFrame:
    """One version per product: an open one first, then the latest start, then the highest id."""
    keyed = versions.filter(F.col("product_key").isNotNull())
    picked = pick_version(
        keyed,
        "product_key",
        ["is_current_version", "start_date", "product_version_id"],
        count_as="product_version_count",
    )
    return picked.select(
        "product_key",
        "product_version_id",
        "product_name",
        "product_cost",
        "product_line",
        "category_id",
        "category_key_prefix",
        "product_key_qualified",
        F.col("start_date").alias("product_start_date"),
        F.col("end_date").alias("product_end_date"),
        "effective_end_date",
        "is_current_version",
        "product_version_count",
        days_between("start_date", "effective_end_date").alias("product_lifecycle_days"),
        "bronze_ingested_at",
    )


def product_lookup(
    current: DataFrame, categories: DataFrame, dim_products: DataFrame | None = None
) -> DataFrame:
    """What a sales line needs to know about its product, one row per product key.

    With ``dim_products`` the surrogate key of the dimension's current version comes along. A
    category id the category table lacks is null here: the line stays, unclassified.
    """
    hierarchy = categories.select(
        F.col("category_id").alias("_category"),
        F.col("category_id").alias("known_category_id"),
        "category_name",
        "subcategory_name",
        "requires_maintenance",
    )
    described = current.join(hierarchy, F.col("category_id") == F.col("_category"), "left").select(
        "product_key",
        "product_version_id",
        "product_name",
        "product_cost",
        "product_line",
        "product_version_count",
        "product_start_date",
        F.col("effective_end_date").alias("product_end_date"),
        F.col("known_category_id").alias("category_id"),
        "category_name",
        "subcategory_name",
        "requires_maintenance",
    )
    if dim_products is None:
        return described
    # The key, and what it is made of.
    keys = dim_products.filter("is_current").select(
        "product_key", "product_sk", F.col("valid_from_date").alias("product_valid_from")
    )
    return described.join(keys, "product_key", "left")


#: Describing columns with few values each, by their names on the side and in the fact.
CUSTOMER_LABELS = {
    "gender": "customer_gender",
    "marital_status": "customer_marital_status",
    "age_band": "customer_age_band",
    "country": "customer_country",
}
PRODUCT_LABELS = {c: c for c in ("product_line", "category_id", "category_name", "subcategory_name", "requires_maintenance")}
#: So many combinations of labels are numbered at most.
_MOST_LABELS = 10_000


@dataclass(frozen=True)
class Labels:
    """The combinations of some columns, each with a number."""

    number: str
    rows: DataFrame


def number_labels(side: DataFrame, names: dict[str, str], number: str) -> tuple[DataFrame, Labels | None]:
    """A side with one number in place of its labels, and the labels of each number, stored.

    The lines then carry the number and get the labels where they are needed, from a broadcast of at most 10,000
    rows. A side with more combinations stays as it is.
    """
    combinations = side.select(*[F.col(old).alias(new) for old, new in names.items()]).distinct()
    counted = combinations.limit(_MOST_LABELS + 1).withColumn(number, F.monotonically_increasing_id())
    rows = stash(counted, "labels")
    if rows.count() > _MOST_LABELS:
        return side, None
    renamed = rows.select(number, *[F.col(new).alias(f"_{new}") for new in names.values()])
    same = reduce(Column.__and__, [F.col(old).eqNullSafe(F.col(f"_{new}")) for old, new in names.items()])
    numbered = side.join(F.broadcast(renamed), same).drop(*names, *[f"_{new}" for new in names.values()])
    return numbered, Labels(number, rows)


def _with_margins(joined: DataFrame) -> DataFrame:
    margins = margin_measures("sales_amount", "quantity", "unit_price", "product_cost")
    line_id = dashed_key("order_number", "product_key")
    return joined.withColumns(margins | {"sales_line_id": line_id})


def price_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales lines with their product and the margins; ``products`` is a ``product_lookup``."""
    return _with_margins(sales.join(products, "product_key", "left"))


def without_measures(sales: DataFrame) -> DataFrame:
    """Lines of ``stg_sales`` without what it derives; ``enrich_sales`` derives that after its joins."""
    return sales.drop(*sales_measures())


# Output columns. Surrogate keys follow when the lookups carry them.
ENRICHED_COLUMNS = (
    "sales_line_id",
    "order_number",
    "product_key",
    "customer_id",
    "customer_key",
    "product_version_id",
    "order_date",
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
    "product_start_date",
    "product_end_date",
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


def enrich_sales(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    by_month: bool = False,
    labels: Sequence[Labels] = (),
) -> DataFrame:
    """One row per sales line with product, hierarchy, margins and customer attributes.

    A line whose customer or product is unknown stays, with nulls. ``products`` is a
    ``product_lookup``; when it or ``customers`` carries a surrogate key, so does the result. Measures that the lines
    lack (``without_measures``) are derived after the joins, with the same values. With ``by_month`` the joined lines
    are gathered by order month and sorted by date and line, as a table with a folder per month stores them, before
    anything wide is derived; the result then has the month's text as ``_month``. ``labels`` are those that the sides
    have as a number only; where products carry the first day of their version (``product_valid_from``), their
    surrogate key is derived from it.
    """
    sk = [c for c in ("customer_sk",) if c in customers.columns]
    buyer = customers.select(
        F.col("customer_id").alias("_buyer"),
        "customer_key",
        "customer_name",
        *[F.col(old).alias(new) for old, new in CUSTOMER_LABELS.items() if old in customers.columns],
        *[x.number for x in labels if x.number in customers.columns],
        *sk,
    )
    dated = "product_valid_from" in products.columns
    sk += [c for c in ("product_sk",) if dated or c in products.columns]
    # What can be computed after the joins need not travel through them, and the product, whose columns are the wider
    # ones, is joined last.
    joined = sales.join(buyer, F.col("customer_id") == F.col("_buyer"), "left").drop("customer_id")
    joined = joined.withColumnRenamed("_buyer", "customer_id").join(products, "product_key", "left")
    if by_month:
        joined = joined.withColumn("_gathered", month_count("order_date")).hint("rebalance", "_gathered").drop("_gathered")
    for known in labels:
        joined = joined.join(F.broadcast(known.rows), known.number, "left")
    if by_month:
        placed = {"_month": year_month("order_date"), "sales_line_id": dashed_key("order_number", "product_key")}
        joined = joined.withColumns(placed).sortWithinPartitions("_month", "order_date", "sales_line_id")
        sk.append("_month")
    if dated:
        joined = joined.withColumn("product_sk", product_sk("product_valid_from"))
    late = {n: c for n, c in sales_measures().items() if n not in sales.columns}
    enriched = _with_margins(joined.withColumns(late) if late else joined)
    return enriched.select(*ENRICHED_COLUMNS, *sk)
