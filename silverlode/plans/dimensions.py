"""Gold dimensions: calendar, customers (type 1), products (type 2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.calendar import as_of_date, calendar_attributes, days_between
from silverlode.operators.scd import scd2
from silverlode.plans.conform import product_sk, with_customer_sk


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date_key") -> DataFrame:
    """Every day from ``start`` up to but not including ``end``."""
    days = (end - start).days
    return spark.range(max(days, 0)).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def date_spine_of(df: DataFrame, date: str, name: str = "date_key") -> DataFrame:
    """Every day between the first and the last date of a frame, both included."""
    bounds = df.agg(F.min(F.col(date).cast("date")).alias("lo"), F.max(F.col(date).cast("date")).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(name))


def dim_dates(
    spark: SparkSession, start: dt.date, end: dt.date, as_of: dt.date | None = None
) -> DataFrame:
    """Calendar of the reporting horizon, independent of the fact: days without orders are there."""
    return describe_dates(date_spine(spark, start, end), as_of)


def describe_dates(spine: DataFrame, as_of: dt.date | None) -> DataFrame:
    """The 19 columns of the date dimension for a frame of ``date_key``."""
    today, day = as_of_date(as_of), F.col("date_key")
    return (
        spine.select("date_key", *[c.alias(n) for n, c in calendar_attributes(day, "date").items()])
        .withColumns(
            {
                "date_year_quarter_key": F.col("date_year") * 100 + F.col("date_quarter"),
                "date_year_month_key": F.col("date_year") * 100 + F.col("date_month_number"),
                "days_ago": days_between(day, today),
                "is_past": day < today,
                "is_today": day == today,
                "is_weekend": F.col("date_day_of_week").isin(1, 7),
            }
        )
    )


def order_rollup(sales: DataFrame) -> DataFrame:
    """Lifetime orders per customer."""
    return sales.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_line_count"),
        F.countDistinct("order_number").alias("order_count"),
        F.sum("quantity").alias("total_units"),
        F.sum("sales_amount").alias("lifetime_sales_amount"),
        F.sum("gross_margin").alias("lifetime_gross_margin"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def dim_customers(customers: DataFrame, sales: DataFrame, as_of: dt.date | None) -> DataFrame:
    """Conformed customers with their order history; ``is_customer`` marks those who ever ordered.

    ``sales`` is any frame of sales lines with ``gross_margin`` (enriched or merely priced): the
    join to the customers decides which ids count.
    """
    return describe_customers(customers, order_rollup(sales), as_of)


def describe_customers(customers: DataFrame, history: DataFrame, as_of: dt.date | None) -> DataFrame:
    """The customer dimension from conformed customers and an ``order_rollup``, derived or kept."""
    today = as_of_date(as_of)
    counts = ("order_line_count", "order_count", "total_units", "lifetime_sales_amount")
    rolled = with_customer_sk(customers).join(history, "customer_id", "left")
    return rolled.select(
        "customer_sk",
        "customer_id",
        "customer_key",
        "customer_first_name",
        "customer_last_name",
        "customer_name",
        "gender",
        "marital_status",
        "birth_date",
        "current_age",
        "age_band",
        "country",
        "customer_created_date",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        "lifetime_gross_margin",
        "first_order_date",
        "last_order_date",
        days_between("first_order_date", today).alias("days_since_first_order"),
        days_between("last_order_date", today).alias("days_since_last_order"),
        F.col("first_order_date").isNotNull().alias("is_customer"),
        F.lit(True).alias("is_current"),
    )


def dim_products(versions: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per product version with a validity window built from the start dates.

    The source's own end dates are not used: they hold the previous version's end.
    """
    dated = versions.filter(F.col("product_key").isNotNull() & F.col("start_date").isNotNull())
    history = scd2(
        dated.select(
            "product_key",
            "product_version_id",
            "product_key_qualified",
            "category_id",
            "product_name",
            "product_cost",
            "product_line",
            "start_date",
        ),
        "product_key",
        "start_date",
        "product_version_id",
    )
    hierarchy = categories.select(
        "category_id", "category_name", "subcategory_name", "requires_maintenance"
    )
    return history.join(hierarchy, "category_id", "left").select(
        product_sk("valid_from_date").alias("product_sk"),
        "product_key",
        "product_version_id",
        "product_key_qualified",
        "category_id",
        "category_name",
        "subcategory_name",
        "requires_maintenance",
        "product_name",
        "product_cost",
        F.col("product_cost").isNotNull().alias("has_product_cost"),
        "product_line",
        "valid_from_date",
        "valid_to_date",
        "is_current",
        "version_number",
        "version_count",
        "valid_for_days",
        F.concat("product_line", F.lit(" / "), "category_name").alias("product_line_category"),
        F.concat("category_id", F.lit(" | "), "category_name").alias("category_label"),
    )
