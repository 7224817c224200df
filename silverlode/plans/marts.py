"""The four aggregate marts over the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverlode.functions.calendar import as_of_date, calendar_attributes, days_between
from silverlode.functions.measures import first_match, plain_average, ratio
from silverlode.functions.text import packed_key
from silverlode.operators.ordering import Ordering, rank_globally
from silverlode.session import stash


# The columns of the fact that each mart reads.
MONTH_COLUMNS = (
    "order_date",
    "order_year_month",
    "order_month_start",
    "order_number",
    "customer_sk",
    "quantity",
    "sales_amount",
    "product_cost",
    "discount_amount",
    "gross_margin",
    "days_to_ship",
    "days_to_due",
)
PRODUCT_COLUMNS = (
    "product_key",
    "order_number",
    "customer_sk",
    "quantity",
    "sales_amount",
    "gross_margin",
    "discount_amount",
    "order_date",
)
CATEGORY_COLUMNS = (
    "category_id",
    "category_name",
    "subcategory_name",
    "product_line",
    "requires_maintenance",
    "product_key",
    "order_number",
    "customer_sk",
    "quantity",
    "sales_amount",
    "gross_margin",
)
ACTIVITY_COLUMNS = ("customer_sk", "order_date", "order_number", "sales_amount")
#: The columns of the customer dimension that the segments show.
BUYER_COLUMNS = ("customer_sk", "customer_id", "customer_key", "customer_name", "gender", "age_band", "country")


def _change(now: str, before: str):
    return ratio(F.col(now) - F.col(before), before, 4)


def kpi_monthly(fact: DataFrame, calendar: bool = False) -> DataFrame:
    """One row per order month with the previous month and the same month a year before.

    "A year before" is twelve rows earlier, so a month without orders shifts it; ``calendar=True``
    looks up the calendar month instead.
    """
    monthly = (
        fact.filter(F.col("order_date").isNotNull())
        .groupBy("order_year_month")
        .agg(
            # A date fits the hash aggregate's buffer; the month and quarter texts, as strings, would
            # turn it into a sort. They follow from the date below.
            F.min("order_month_start").alias("_month"),
            F.countDistinct("order_number").alias("order_count"),
            F.countDistinct("customer_sk").alias("active_customers"),
            F.sum("quantity").alias("units_sold"),
            F.sum("sales_amount").alias("gross_revenue"),
            F.sum(F.col("quantity") * F.col("product_cost")).alias("cost_of_goods"),
            F.sum("discount_amount").alias("discount_amount"),
            F.sum("gross_margin").alias("gross_margin"),
            F.sum("days_to_ship").alias("_ship_days"),
            F.sum("days_to_due").alias("_due_days"),
            F.count(F.lit(1)).alias("_lines"),
        )
    )
    # One row per month from here on: a single ordered partition is a few hundred rows.
    named = calendar_attributes("_month", "m")
    monthly = monthly.withColumns(
        {
            "report_year": named["m_year"],
            "report_month_number": named["m_month_number"],
            "report_month_name": named["m_month_name"],
            "report_quarter": named["m_year_quarter"],
        }
    )
    if calendar:
        months = F.col("report_year") * 12 + F.col("report_month_number")
        along = W.orderBy(months)
        previous = F.first("gross_revenue").over(along.rangeBetween(-1, -1))
        last_year = F.first("gross_revenue").over(along.rangeBetween(-12, -12))
    else:
        along = W.orderBy("order_year_month")
        previous = F.lag("gross_revenue").over(along)
        last_year = F.lag("gross_revenue", 12).over(along)
    trended = monthly.withColumns({"prior_month_revenue": previous, "prior_year_revenue": last_year})
    return trended.select(
        "order_year_month",
        "report_year",
        "report_month_number",
        "report_month_name",
        "report_quarter",
        "order_count",
        "active_customers",
        "units_sold",
        "gross_revenue",
        "cost_of_goods",
        "discount_amount",
        "gross_margin",
        ratio("gross_margin", "gross_revenue", 4).alias("gross_margin_pct"),
        ratio("gross_revenue", "order_count", 2).alias("average_order_value"),
        ratio("gross_revenue", "active_customers", 2).alias("revenue_per_customer"),
        ratio("gross_revenue", "units_sold", 2).alias("average_unit_price"),
        plain_average("_ship_days", "_lines").alias("avg_days_to_ship"),
        plain_average("_due_days", "_lines").alias("avg_days_to_due"),
        "prior_month_revenue",
        "prior_year_revenue",
        _change("gross_revenue", "prior_month_revenue").alias("revenue_mom_pct"),
        _change("gross_revenue", "prior_year_revenue").alias("revenue_yoy_pct"),
    ).orderBy("order_year_month")


def product_performance(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Sold products by revenue, with cumulative share and ABC class.

    ``revenue_rank`` is a row number (ties by product key); ``revenue_tiebreak`` is the dense rank.
    Class A ends at a cumulative 80 % of revenue, B at 95 %.
    """
    sold = fact.groupBy("product_key").agg(
        F.countDistinct("order_number").alias("order_count"),
        F.countDistinct(packed_key("customer_sk")).alias("buyer_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("sales_amount").alias("gross_revenue"),
        F.sum("gross_margin").alias("gross_margin"),
        F.sum("discount_amount").alias("discount_amount"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    ranked = rank_globally(
        sold,
        Ordering(
            [F.desc_nulls_last("gross_revenue"), F.asc_nulls_last("product_key")],
            row_number="revenue_rank",
            dense_rank={"revenue_tiebreak": "gross_revenue"},
            running_sum={"_revenue_so_far": "gross_revenue"},
            total={"_portfolio": "gross_revenue"},
        ),
    )
    described = dim_products.filter("is_current").select(
        "product_key",
        "product_sk",
        "product_name",
        "product_line",
        "category_id",
        "category_name",
        "subcategory_name",
        "product_cost",
    )
    # Compared as products, not quotients: a share of exactly 80 % is in A.
    so_far, portfolio = F.col("_revenue_so_far"), F.col("_portfolio")
    return ranked.join(described, "product_key").select(
        *described.columns,
        "revenue_rank",
        "revenue_tiebreak",
        "order_count",
        "buyer_count",
        "units_sold",
        "gross_revenue",
        "gross_margin",
        "discount_amount",
        ratio("gross_margin", "gross_revenue", 4).alias("gross_margin_pct"),
        ratio("gross_revenue", "units_sold", 2).alias("average_unit_price"),
        ratio("gross_revenue", "order_count", 2).alias("average_order_value"),
        "first_order_date",
        "last_order_date",
        ratio(so_far, portfolio, 4).alias("cumulative_revenue_share"),
        first_match(
            [(so_far * 100 <= portfolio * 80, "A"), (so_far * 100 <= portfolio * 95, "B")], "C"
        ).alias("abc_class"),
    )


CATEGORY_GRAIN = ("category_id", "subcategory_name", "product_line", "requires_maintenance")


def _classified(fact: DataFrame) -> DataFrame:
    return fact.select(
        F.coalesce("category_id", F.lit("UNCLASSIFIED")).alias("category_id"),
        F.coalesce("category_name", F.lit("Unclassified")).alias("category_name"),
        F.coalesce("subcategory_name", F.lit("Unclassified")).alias("subcategory_name"),
        F.coalesce("product_line", F.lit("Other")).alias("product_line"),
        F.coalesce("requires_maintenance", F.lit(False)).alias("requires_maintenance"),
        "product_key",
        "order_number",
        "customer_sk",
        "quantity",
        "sales_amount",
        "gross_margin",
    )


def category_sums(fact: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Sums and distinct counts of the fact per category grain, or, with ``numbers`` (a ``grain_number`` for each
    grain of the fact), per number: a number and half of a hashed key cross the network for every order and buyer."""
    lines, grain = _classified(fact), CATEGORY_GRAIN
    if numbers is not None:
        lines, grain = lines.join(numbers, list(CATEGORY_GRAIN)), ("grain_number",)
    return lines.groupBy(*grain).agg(
        F.countDistinct("order_number").alias("order_count"),
        F.countDistinct(packed_key("customer_sk")).alias("buyer_count"),
        F.countDistinct("product_key").alias("product_count"),
        F.count(F.lit(1)).alias("order_line_count"),
        F.sum("quantity").alias("units_sold"),
        F.sum("sales_amount").alias("gross_revenue"),
        F.sum("gross_margin").alias("gross_margin"),
    )


def category_rollup(fact: DataFrame) -> DataFrame:
    """Revenue, margin and portfolio shares per category, subcategory, line and maintenance flag.

    Distinct orders, buyers and products are counted at this grain in the same aggregation.
    """
    # The name apart: a maximum of texts would turn the big aggregate into a sort. Distinct
    # combinations are a handful, combined on the map side. They are stored with a number each.
    names = _classified(fact).select(*CATEGORY_GRAIN, "category_name").distinct()
    names = names.groupBy(*CATEGORY_GRAIN).agg(F.max("category_name").alias("category_name"))
    names = stash(names.withColumn("grain_number", F.monotonically_increasing_id()), "category-names")
    # A row per category, stored: the totals are added up from these rows, not from the fact again.
    rolled = stash(category_sums(fact, names.drop("category_name")), "category-rollup")
    revenue, margin = rolled.agg(F.sum("gross_revenue")).scalar(), rolled.agg(F.sum("gross_margin")).scalar()
    has_margin = F.col("gross_margin") != 0
    joined = rolled.join(names, "grain_number").withColumns({"_revenue": revenue, "_margin": margin})
    return joined.select(
        "category_id",
        "category_name",
        "subcategory_name",
        "product_line",
        "requires_maintenance",
        "order_count",
        "buyer_count",
        "product_count",
        "order_line_count",
        "units_sold",
        "gross_revenue",
        "gross_margin",
        ratio("gross_margin", "gross_revenue", 4).alias("gross_margin_pct"),
        ratio("gross_revenue", "units_sold", 2).alias("average_unit_price"),
        ratio("gross_revenue", "order_count", 2).alias("average_order_value"),
        ratio("gross_revenue", "_revenue", 4).alias("revenue_share"),
        F.when(has_margin, ratio("gross_margin", "_margin", 4)).alias("margin_share"),
    )


def category_report(rollup: DataFrame) -> DataFrame:
    """Ad-hoc view of the category mart: names by whole revenue, largest first."""
    report = rollup.select("category_name", F.round("gross_revenue").alias("revenue"))
    return report.orderBy(F.desc_nulls_last("revenue"), "category_name")


def _segment():
    """Fixed rules, first match wins, over the three scores."""
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 3) & (f >= 4), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "Recent Customers"),
            ((r <= 2) & (f >= 3), "At Risk"),
            ((r <= 2) & (f <= 2), "Hibernating"),
            (m == 5, "Big Spenders"),
        ],
        "Need Attention",
    )


def rfm_segments(
    fact: DataFrame,
    dim_customers: DataFrame,
    as_of: dt.date | None = None,
    count_orders: bool = False,
) -> DataFrame:
    """Recency, frequency and monetary fifths of every buyer, and the segment they imply.

    ``frequency_orders`` counts order lines, as its consumers expect; ``count_orders=True`` counts
    distinct orders. Ties inside a measure go by customer id. The fact is aggregated before the
    join, so a customer with very many lines is one row by then.
    """
    frequency = F.countDistinct("order_number") if count_orders else F.count(F.lit(1))
    activity = fact.groupBy("customer_sk").agg(
        F.max("order_date").alias("last_order_date"),
        frequency.alias("frequency_orders"),
        F.sum("sales_amount").alias("monetary_value"),
    )
    buyers = dim_customers.filter("is_customer").select(*BUYER_COLUMNS)
    recency = days_between("last_order_date", as_of_date(as_of))
    by_id = F.asc_nulls_last("customer_id")
    # The last fifth scores 5, so the longest absence comes first.
    scored = rank_globally(
        buyers.join(activity, "customer_sk").withColumn("recency_days", recency),
        Ordering([F.desc_nulls_last("recency_days"), by_id], ntile={"recency_score": 5}),
        Ordering([F.asc_nulls_last("frequency_orders"), by_id], ntile={"frequency_score": 5}),
        Ordering([F.asc_nulls_last("monetary_value"), by_id], ntile={"monetary_score": 5}),
    )
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.select(
        *buyers.columns,
        "recency_days",
        "frequency_orders",
        "monetary_value",
        "last_order_date",
        "recency_score",
        "frequency_score",
        "monetary_score",
        total.alias("rfm_total_score"),
        _segment().alias("customer_segment"),
    )
