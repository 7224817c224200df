"""The whole warehouse, wired: bronze to silver to gold to marts, with checks in between."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from silverlode.config import Settings
from silverlode.operators.layout import materialise, published
from silverlode.operators.quality import run_checks
from silverlode.operators.versioned import VersionedTable
from silverlode.plans import checks, conform, dimensions, fact, marts, staging
from silverlode.plans.customer_orders import OrderHistory
from silverlode.plans.silver_sales import SalesStore
from silverlode.session import stash
from silverlode.sources.bronze import read_bronze


GOLD_TABLES = (
    "dim_dates",
    "dim_products",
    "dim_customers",
    "agg_kpi__monthly_performance",
    "agg_products__performance",
    "agg_products__category_rollup",
    "agg_customers__rfm_segmentation",
)

#: The tables in the order in which ``build`` returns them.
_BUILT = ("dim_dates", "dim_products", "dim_customers", "fct_sales", *GOLD_TABLES[3:])


class BronzeExtracts:
    """The six raw extracts with their lineage columns, each opened when first asked for."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self._open = lambda table: read_bronze(spark, settings.layer("bronze"), table)

    @cached_property
    def customers(self) -> DataFrame:
        return self._open("crm_cust_info")

    @cached_property
    def products(self) -> DataFrame:
        return self._open("crm_prd_info")

    @cached_property
    def sales(self) -> DataFrame:
        return self._open("crm_sales_details")

    @cached_property
    def attributes(self) -> DataFrame:
        return self._open("erp_cust_az12")

    @cached_property
    def geography(self) -> DataFrame:
        return self._open("erp_loc_a101")

    @cached_property
    def categories(self) -> DataFrame:
        return self._open("erp_px_cat_g1v2")


class Silver:
    """The cleaned extracts, lazy: a consumer pays for the frames and columns it reads.

    ``raw`` is anything with the six attributes of ``BronzeExtracts``.
    """

    def __init__(self, raw):
        self.raw = raw

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def sales(self) -> DataFrame:
        return staging.stg_sales(self.raw.sales)

    @cached_property
    def attributes(self) -> DataFrame:
        return staging.stg_attributes(self.raw.attributes)

    @cached_property
    def geography(self) -> DataFrame:
        return staging.stg_geography(self.raw.geography)

    @cached_property
    def categories(self) -> DataFrame:
        return staging.stg_categories(self.raw.categories)


def conformed_customers(clean: Silver, settings: Settings) -> DataFrame:
    return conform.conform_customers(
        clean.customers, clean.attributes, clean.geography, settings.as_of
    )


def stored_lookup(clean: Silver, dim_products: DataFrame) -> DataFrame:
    """The product side of the sales joins, written once.

    Spark estimates the size of joined frames as the product of their inputs and would never
    broadcast this one; from files it knows the real size. A small product table is then
    broadcast and the sales lines stay where they are, a large one is joined by sort and merge.
    """
    current = conform.current_products(clean.products)
    return stash(conform.product_lookup(current, clean.categories, dim_products), "product-lookup")


@dataclass(frozen=True)
class Sides:
    """What the sales lines are joined to, stored: products with history, customers, lookup."""

    items: DataFrame
    people: DataFrame
    lookup: DataFrame


def store_sides(clean: Silver, settings: Settings) -> Sides:
    with ThreadPoolExecutor(max_workers=1) as pool:
        # Read by the history, twice, and by the lookup.
        clean.products = stash(clean.products, "product-versions")
        customers = conform.with_customer_sk(conformed_customers(clean, settings))
        people = pool.submit(stash, customers, "customers")
        items = stash(dimensions.dim_products(clean.products, clean.categories), "products")
        return Sides(items, people.result(), stored_lookup(clean, items))


def fact_lines(
    clean: Silver, customers: DataFrame, lookup: DataFrame, by_month: bool = False, whole: bool = False
) -> DataFrame:
    """All fact rows. ``customers`` is the dimension or the conformed frame. Two joins of the sales lines in all;
    measures and surrogate keys follow from joined columns and do not travel through them, nor, with ``by_month``,
    through the exchange that gathers the lines of a month for ``VersionedTable.overwrite``. With ``whole``, for
    consumers of all columns, labels with few values travel as one number per side."""
    lines, labels = conform.without_measures(clean.sales), []
    customers = customers.drop("customer_sk")
    if whole:
        customers, buyers = conform.number_labels(customers, conform.CUSTOMER_LABELS, "_customer_labels")
        lookup, kinds = conform.number_labels(lookup, conform.PRODUCT_LABELS, "_product_labels")
        labels = [x for x in (buyers, kinds) if x is not None]
    enriched = conform.enrich_sales(lines, customers, lookup, by_month, labels)
    return fact.fact_rows(conform.with_customer_sk(enriched))


def customer_dimension(
    clean: Silver, customers: DataFrame, lookup: DataFrame, settings: Settings
) -> DataFrame:
    priced = conform.price_sales(clean.sales, lookup)
    return dimensions.dim_customers(customers, priced, settings.as_of)


def _together(*steps: Callable[[], Any]) -> list[Any]:
    """The results of independent steps, run side by side. The first that fails stops the job, once all have ended."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
    return [step.result() for step in running]


def refresh_sales(
    table: VersionedTable,
    sales: SalesStore,
    customers: DataFrame,
    lookup: DataFrame,
    settings: Settings,
    full: bool = False,
    late: bool = False,
    fresh: Sequence[str] | None = None,
) -> int:
    """Parse new batches and bring the fact up to date; returns the fact's version.

    The fact is rebuilt from all stored lines (``full``), or those from the lookback window on are upserted. With
    ``late`` every line of the new batches is, also one that is older than the window. Only files that may hold
    such lines are read, and no old batch is parsed again. ``fresh``: what ``sales.refresh`` returned, if it was
    called already.
    """
    fresh = sales.refresh() if fresh is None else fresh
    since = None if full else fact.lookback_start(table, settings.lookback_days)
    lines = sales.read() if since is None else sales.recent(since, fresh if late else ())
    clean = Silver(None)
    clean.sales = lines
    rows = fact_lines(clean, customers, lookup, by_month=True, whole=True)
    write = table.overwrite if since is None else table.upsert
    return write(rows, fact.FACT_SORT, placed=True)


def build(
    spark: SparkSession, raw, settings: Settings, full: bool = False, late: bool = False
) -> dict[str, DataFrame]:
    """Build every gold table and mart; returns the stored tables.

    Dimensions and marts are rebuilt, the fact is refreshed over its lookback window (and, with ``late``, by
    all lines of new batches), or rebuilt with ``full``. Only new batches of sales are parsed, and the order
    history of the customers reads only their lines unless product costs changed.
    """
    gold = settings.layer("gold")
    clean = Silver(raw)
    sales_store = SalesStore(spark, settings)
    table = fact.fact_table(spark, f"{gold}/fct_sales", repeats=True)
    stored: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, cluster_by: tuple[str, ...] = ()) -> DataFrame:
        stored[name] = materialise(df, "gold", name, settings.root, cluster_by)
        return stored[name]

    def items() -> DataFrame:
        # Read by the history, twice, and by the lookup.
        clean.products = stash(clean.products, "product-versions")
        return keep(
            "dim_products",
            dimensions.dim_products(clean.products, clean.categories),
            ("product_key", "category_id", "is_current"),
        )

    def people() -> DataFrame:
        history = OrderHistory(spark, settings, sales_store)
        history.refresh(lookup, full)
        return keep(
            "dim_customers",
            dimensions.describe_customers(conformed, history.read(lookup), settings.as_of),
            ("customer_key", "country"),
        )

    dates = dimensions.dim_dates(spark, settings.calendar_start, settings.calendar_end, settings.as_of)
    # What does not need each other runs side by side: one step's last tasks leave cores to the next step.
    conformed, _, products, fresh = _together(
        lambda: stash(conform.with_customer_sk(conformed_customers(clean, settings)), "customers"),
        lambda: keep("dim_dates", dates, ("date_key",)),
        items,
        sales_store.refresh,
    )
    lookup = stored_lookup(clean, products)
    # The fact takes the customers from their conformed form.
    _, customers = _together(
        lambda: refresh_sales(table, sales_store, conformed, lookup, settings, full, late, fresh), people
    )
    sales = stored["fct_sales"] = table.read()
    _together(
        lambda: keep("agg_products__performance", marts.product_performance(sales, products)),
        lambda: keep("agg_products__category_rollup", marts.category_rollup(sales)),
        lambda: keep("agg_customers__rfm_segmentation", marts.rfm_segments(sales, customers, settings.as_of)),
        lambda: keep("agg_kpi__monthly_performance", marts.kpi_monthly(sales)),
    )
    return {name: stored[name] for name in _BUILT}


def open_gold(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The stored tables of the last ``build``."""
    gold = settings.layer("gold")
    stored = {name: published(spark, f"{gold}/{name}") for name in GOLD_TABLES}
    stored["fct_sales"] = fact.fact_table(spark, f"{gold}/fct_sales").read()
    return stored


def check(
    raw, stored: dict[str, DataFrame], settings: Settings, stop_on_error: bool = True
) -> list[dict]:
    """All declared checks; offending rows land in the ``checks`` layer.

    Several checks read each cleaned table and the enriched sales, so these are stored once instead of
    being parsed and deduplicated from raw text each time.
    """
    clean = Silver(raw)
    for name in ("customers", "products", "sales", "attributes", "geography", "categories"):
        setattr(clean, name, stash(getattr(clean, name), f"checked-{name}"))
    customers = stash(conformed_customers(clean, settings), "checked-conformed")
    current = conform.current_products(clean.products)
    lookup = stash(conform.product_lookup(current, clean.categories), "checked-lookup")
    enriched = stash(conform.enrich_sales(clean.sales, customers, lookup), "checked-enriched")
    tables = checks.source_checks(raw) | checks.silver_checks(clean, raw, settings)
    tables |= checks.conformed_checks(customers, current, enriched)
    tables |= checks.gold_checks(stored, clean) | checks.mart_checks(stored)
    return run_checks(tables, settings.layer("checks"), stop_on_error)
