"""The declared checks of every layer."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.config import Settings
from silverlode.functions.calendar import AGE_BANDS, OLDEST_BAND
from silverlode.operators import quality as q

GENDERS = ("Male", "Female", "Unknown")
MARITAL = ("Married", "Single", "Unknown")
AGES = ("Unknown", *[label for _, label in AGE_BANDS], OLDEST_BAND)
SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "Recent Customers",
    "At Risk",
    "Hibernating",
    "Big Spenders",
    "Need Attention",
)

Tables = dict[str, tuple[DataFrame, list[q.Check]]]


def _filled(raw: DataFrame, column: str) -> DataFrame:
    """Blank ids are nulls to the checks."""
    return raw.withColumn(column, F.nullif(F.trim(column), F.lit("")))


def source_checks(raw) -> Tables:
    """Raw extracts. A customer feed repeats ids by nature, so that is a warning; silver resolves it."""
    warn = "warn"
    return {
        "crm_cust_info": (
            _filled(raw.customers, "cst_id"),
            [
                *q.not_null("cst_id", severity=warn),
                *q.not_null("cst_key"),
                q.unique_combination("cst_id", severity=warn),
            ],
        ),
        "crm_prd_info": (
            _filled(raw.products, "prd_id"),
            [*q.not_null("prd_id", "prd_key"), q.unique_combination("prd_id")],
        ),
        "crm_sales_details": (
            raw.sales,
            [*q.not_null("sls_ord_num"), q.unique_combination("sls_ord_num", "sls_prd_key")],
        ),
        "erp_cust_az12": (raw.attributes, [*q.not_null("CID"), q.unique_combination("CID")]),
        "erp_loc_a101": (raw.geography, [*q.not_null("CID"), q.unique_combination("CID")]),
        "erp_px_cat_g1v2": (raw.categories, [*q.not_null("ID"), q.unique_combination("ID")]),
    }


def source_freshness(raw, settings: Settings, now=None) -> dict[str, DataFrame | None]:
    """Age of every extract's newest load; None for an extract that was never loaded."""
    hours = settings.freshness_warn_hours, settings.freshness_error_hours
    extracts = ("customers", "products", "sales", "attributes", "geography", "categories")
    found: dict[str, DataFrame | None] = {}
    for name in extracts:
        try:
            found[name] = q.freshness(getattr(raw, name), "_ingested_at", now, *hours)
        except AnalysisException:  # no such folder
            found[name] = None
    return found


def silver_checks(clean, raw, settings: Settings) -> Tables:
    positive = ("sales_amount > 0", "quantity > 0", "unit_price > 0", "days_to_ship >= 0")
    rate = q.rejection_rate(raw.sales, clean.sales, settings.max_rejection_rate)
    return {
        "stg_customers": (
            clean.customers,
            [
                *q.not_null("customer_id", "customer_key"),
                *q.unique("customer_id"),
                q.accepted("gender", GENDERS),
                q.accepted("marital_status", MARITAL),
            ],
        ),
        "stg_products": (
            clean.products,
            [
                *q.not_null("product_version_id", "product_key"),
                *q.unique("product_version_id"),
                q.accepted("is_current_version", (True, False)),
            ],
        ),
        "stg_sales": (
            clean.sales,
            [
                *q.not_null(
                    "order_number",
                    "customer_id",
                    "sales_amount",
                    "quantity",
                    "unit_price",
                    "order_date",
                    "ship_date",
                    "due_date",
                ),
                q.unique_combination("order_number", "product_key"),
                *[q.expression(sql.split()[0], sql) for sql in positive],
                q.QueryCheck("rejection_rate", rate.filter("exceeds_cap")),
            ],
        ),
        "stg_attributes": (
            clean.attributes,
            [
                *q.not_null("erp_customer_id", "customer_key"),
                *q.unique("erp_customer_id"),
                q.accepted("gender", GENDERS),
            ],
        ),
        "stg_geography": (
            clean.geography,
            [
                *q.not_null("erp_customer_id", "customer_key", "country"),
                *q.unique("erp_customer_id"),
                q.QueryCheck("unmapped_country", q.unmapped_codes(clean.geography, "country")),
            ],
        ),
        "stg_categories": (
            clean.categories,
            [
                *q.not_null("category_id", "category_name", "subcategory_name"),
                *q.unique("category_id"),
            ],
        ),
    }


def conformed_checks(customers: DataFrame, current: DataFrame, enriched: DataFrame) -> Tables:
    return {
        "conformed_customers": (
            customers,
            [
                *q.not_null("customer_id", "customer_key"),
                *q.unique("customer_id"),
                q.accepted("age_band", AGES),
            ],
        ),
        "current_products": (
            current,
            [q.unique_combination("product_key"), q.expression("is_current", "is_current_version = true")],
        ),
        "sales_enriched": (
            enriched,
            [
                *q.not_null("sales_line_id", "customer_id", "product_key", "order_date", "sales_amount"),
                *q.unique("sales_line_id"),
                q.expression("gross_margin", "gross_margin is not null"),
            ],
        ),
    }


def gold_checks(stored: dict[str, DataFrame], clean) -> Tables:
    sales, items = stored["fct_sales"], stored["dim_products"]
    reconciled = q.reconcile(sales, clean.sales, "sales_line_id", "sales_amount", "quantity")
    lost = q.referential_breaks(
        sales, "sales_line_id", {"missing_customer": "customer_sk", "missing_product": "product_sk"}
    )
    return {
        "dim_customers": (
            stored["dim_customers"],
            [
                *q.not_null("customer_sk", "customer_id", "customer_key", "country"),
                *q.unique("customer_sk", "customer_id", "customer_key"),
                q.accepted("gender", GENDERS),
                q.accepted("marital_status", MARITAL),
                q.accepted("age_band", AGES),
            ],
        ),
        "dim_products": (
            items,
            [
                *q.not_null(
                    "product_sk", "product_key", "valid_from_date", "valid_to_date", "is_current", "version_number"
                ),
                *q.unique("product_sk"),
                q.accepted("is_current", (True, False)),
                q.unique_combination("product_key", "valid_from_date"),
                q.QueryCheck(
                    "version_integrity", q.version_breaks(items, "product_key").filter("offending_rows > 0")
                ),
            ],
        ),
        "dim_dates": (
            stored["dim_dates"],
            [
                *q.not_null("date_key", "date_year", "date_quarter", "date_year_month", "is_weekend"),
                *q.unique("date_key"),
                q.expression(
                    "ranges", "date_quarter between 1 and 4 and date_month_number between 1 and 12"
                ),
            ],
        ),
        "fct_sales": (
            sales,
            [
                *q.not_null(
                    "sales_line_id",
                    "customer_sk",
                    "product_sk",
                    "order_date",
                    "order_year",
                    "order_year_month",
                    "sales_amount",
                    "quantity",
                    "gross_margin",
                    "days_to_ship",
                ),
                *q.unique("sales_line_id"),
                q.expression("measures", "sales_amount > 0 and quantity > 0 and unit_price > 0"),
                q.expression("dates", "ship_date >= order_date and due_date >= ship_date"),
                q.expression(
                    "ranges", "order_month_number between 1 and 12 and order_quarter between 1 and 4"
                ),
                q.QueryCheck("reconciles_to_sales", q.reconcile_breaks(reconciled)),
                q.QueryCheck("referential_integrity", lost.filter("offending_rows > 0")),
            ],
        ),
    }


def mart_checks(stored: dict[str, DataFrame]) -> Tables:
    products = stored["agg_products__performance"]
    categories = stored["agg_products__category_rollup"]
    months = stored["agg_kpi__monthly_performance"]
    segments = stored["agg_customers__rfm_segmentation"]
    scores = ("recency_score", "frequency_score", "monetary_score")
    gaps = mart_gaps(stored["fct_sales"], months, products, categories, segments)
    return {
        "agg_kpi__monthly_performance": (
            months,
            [
                *q.not_null("order_year_month", "gross_revenue", "gross_margin", "order_count"),
                *q.unique("order_year_month"),
                q.expression("positive", "gross_revenue > 0 and units_sold > 0 and order_count > 0"),
                q.QueryCheck("marts_reconcile_to_fact", gaps.filter("revenue_gap <> 0 or units_gap <> 0"), "warn"),
            ],
        ),
        "agg_products__performance": (
            products,
            [
                *q.not_null("product_key", "revenue_rank", "cumulative_revenue_share", "abc_class"),
                *q.unique("product_key"),
                q.accepted("abc_class", ("A", "B", "C")),
                q.expression("share", "cumulative_revenue_share > 0 and cumulative_revenue_share <= 1.0001"),
            ],
        ),
        "agg_products__category_rollup": (
            categories,
            [
                *q.not_null("category_id", "gross_revenue", "revenue_share"),
                q.unique_combination("category_id", "subcategory_name", "product_line", "requires_maintenance"),
            ],
        ),
        "agg_customers__rfm_segmentation": (
            segments,
            [
                *q.not_null("customer_sk", *scores, "customer_segment"),
                *q.unique("customer_sk"),
                q.accepted("customer_segment", SEGMENTS),
                q.expression("scores", " and ".join(f"{s} between 1 and 5" for s in scores)),
            ],
        ),
    }


def mart_gaps(
    fact: DataFrame, months: DataFrame, products: DataFrame, categories: DataFrame, segments: DataFrame
) -> DataFrame:
    """Revenue and units of each mart less those of the fact, one row per mart.

    Zero for months and categories. Products without a current dimension row and lines without a
    customer are left out of their marts on purpose and show up here. Customers have no units.
    """

    def part(name: str, df: DataFrame, revenue: str, units: str | None) -> DataFrame:
        return df.select(
            F.lit(name).alias("mart"),
            F.col(revenue).cast("decimal(38,2)").alias("revenue"),
            (F.col(units) if units else F.lit(0)).cast("bigint").alias("units"),
        )

    stacked = q.union_all(
        [
            part("fact", fact, "sales_amount", "quantity"),
            part("months", months, "gross_revenue", "units_sold"),
            part("products", products, "gross_revenue", "units_sold"),
            part("categories", categories, "gross_revenue", "units_sold"),
            part("customers", segments, "monetary_value", None),
        ]
    )
    totals = stacked.groupBy("mart").agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"),
    )
    fact_total = totals.filter(F.col("mart") == "fact")
    revenue = F.col("revenue") - fact_total.select("revenue").scalar()
    units = F.col("units") - fact_total.select("units").scalar()
    return totals.filter(F.col("mart") != "fact").select(
        "mart",
        revenue.alias("revenue_gap"),
        F.when(F.col("mart") != "customers", units).otherwise(F.lit(0)).alias("units_gap"),
    )
