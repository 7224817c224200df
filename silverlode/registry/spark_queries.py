"""Registered queries: every operator on whole test tables, ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.config import Settings
from silverlode.operators import dedup, layout, ordering, quality, reject, scd, versioned
from silverlode.plans import checks, conform, customer_orders, dimensions, fact, marts, silver_sales, staging, warehouse
from silverlode.registry.raw_extracts import DerivedExtracts as raw
from silverlode.registry.raw_extracts import raw_frame
from silverlode.registry.raw_extracts import read_table as table
from silverlode.session import CODEC, scratch_path, stash
from silverlode.sources import bronze, headers
from silverlode.sources.specs import RESCUED, sources
from silverlode.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(2026, 1, 1)
SETTINGS = Settings(as_of=AS_OF)
LOADED_AT = dt.datetime(2026, 1, 1)


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, decimals as double, timestamps without zone: types both engines have."""
    columns = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def clean(spark: SparkSession, sf_dir: str) -> warehouse.Silver:
    return warehouse.Silver(raw(spark, sf_dir))


class Gold:
    """Dimensions and fact of one query; the sides the sales are joined to are stored first."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.clean = clean(spark, sf_dir)
        self.sides = warehouse.store_sides(self.clean, SETTINGS)

    @property
    def items(self) -> DataFrame:
        return self.sides.items

    @property
    def people(self) -> DataFrame:
        return warehouse.customer_dimension(self.clean, self.sides.people, self.sides.lookup, SETTINGS)

    @property
    def fact(self) -> DataFrame:
        return warehouse.fact_lines(self.clean, self.sides.people, self.sides.lookup)

    @property
    def placed_fact(self) -> DataFrame:
        """The fact gathered by month, to be stored by month."""
        return warehouse.fact_lines(self.clean, self.sides.people, self.sides.lookup, by_month=True, whole=True)

    def stored_fact(self, *columns: str) -> DataFrame:
        """Written once, as the warehouse does, for marts that read it more than once; in the columns they read. The
        customers' surrogate keys follow from their natural keys, which are a third as long, and are not stored."""
        rows = self.fact
        wanted = list(dict.fromkeys(columns)) or rows.columns
        kept = dict.fromkeys("customer_key" if c == "customer_sk" else c for c in wanted)
        return conform.with_customer_sk(stash(rows.select(*kept), "fact")).select(*wanted)


def fact_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Gold(spark, sf_dir).fact


def _without_lineage(df: DataFrame) -> DataFrame:
    return df.drop("bronze_ingested_at", "bronze_source_file")


# --- silver ----------------------------------------------------------------------------------------


@query
def clean_customers(spark, sf_dir):
    return _without_lineage(clean(spark, sf_dir).customers)


@query
def clean_products(spark, sf_dir):
    return _without_lineage(clean(spark, sf_dir).products)


@query
def clean_sales(spark, sf_dir):
    return _without_lineage(clean(spark, sf_dir).sales)


@query
def rejected_sales_by_reason(spark, sf_dir):
    return reject.count_by_reason(staging.rejected_sales(raw(spark, sf_dir).sales))


@query
def clean_attributes(spark, sf_dir):
    return _without_lineage(clean(spark, sf_dir).attributes)


@query
def clean_geography(spark, sf_dir):
    return clean(spark, sf_dir).geography


@query
def clean_categories(spark, sf_dir):
    return clean(spark, sf_dir).categories


@query
def dedup_latest_events(spark, sf_dir):
    """Newest event per user and type."""
    events = table(spark, sf_dir, "events")
    newest = [F.desc_nulls_last("ts"), F.desc_nulls_last("event_id")]
    return dedup.dedup_latest(events, ["user_id", "event_type"], newest)


@query
def dedup_completeness(spark, sf_dir):
    """The fullest order per customer and status: an urgent order with a total counts as fuller."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "priority": F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")),
            "large": F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")),
        }
    )
    scored = orders.withColumn("filled", dedup.completeness({"priority": 2, "large": 1}))
    order = [F.col("filled").desc(), F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    best = dedup.dedup_latest(scored, ["o_custkey", "o_orderstatus"], order)
    return best.select("o_custkey", "o_orderstatus", "o_orderkey", "filled")


@query
def current_product_version(spark, sf_dir):
    return conform.current_products(clean(spark, sf_dir).products).drop("bronze_ingested_at")


# --- conformed and gold ----------------------------------------------------------------------------


@query
def conform_customers(spark, sf_dir):
    return warehouse.conformed_customers(clean(spark, sf_dir), SETTINGS)


@query
def sales_enriched(spark, sf_dir):
    c = clean(spark, sf_dir)
    products = conform.product_lookup(conform.current_products(c.products), c.categories)
    people = warehouse.conformed_customers(c, SETTINGS)
    return conform.enrich_sales(c.sales, people, products).drop("bronze_ingested_at")


@query
def dim_dates(spark, sf_dir):
    """Calendar of the order history with the orders of each day; days without orders stay."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date_key"))
    calendar = dimensions.describe_dates(dimensions.date_spine_of(orders, "date_key"), AS_OF)
    per_day = orders.groupBy("date_key").agg(F.count(F.lit(1)).alias("orders"))
    counted = calendar.join(per_day, "date_key", "left")
    return counted.withColumn("orders", F.coalesce("orders", F.lit(0)))


@query
def dim_customers(spark, sf_dir):
    return Gold(spark, sf_dir).people


@query
def dim_products_scd2(spark, sf_dir):
    c = clean(spark, sf_dir)
    return dimensions.dim_products(c.products, c.categories)


@query
def scd2_events(spark, sf_dir):
    """Event type per user and day as a versioned attribute."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("date").alias("day")
    )
    return scd.scd2(events, "user_id", "day", "event_id").drop("day")


@query
def scd2_events_hot_keys(spark, sf_dir):
    """The user of each event as a history of the event type: a handful of keys hold all rows."""
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.col("ts").cast("date").alias("day")
    )
    return scd.scd2(events, "event_type", "day", "event_id").drop("day")


@query
def fct_sales_full(spark, sf_dir):
    gold = Gold(spark, sf_dir)
    rows = warehouse.fact_lines(gold.clean, gold.sides.people, gold.sides.lookup, whole=True)
    return rows.drop("bronze_ingested_at")


@query
def fct_sales_from_dimensions(spark, sf_dir):
    """The fact with its surrogate keys looked up in the dimensions."""
    gold = Gold(spark, sf_dir)
    c = gold.clean
    products = conform.product_lookup(conform.current_products(c.products), c.categories)
    lines = conform.without_measures(c.sales)
    sides = warehouse.conformed_customers(c, SETTINGS), products
    built = fact.build_fact(lines, gold.people, gold.items, sides)
    return built.drop("bronze_ingested_at")


# --- incremental -----------------------------------------------------------------------------------

_CUT = "2001-05-31"
def _stored_before(rows: DataFrame) -> DataFrame:
    """The fact as an earlier run left it: up to the cut, every amount one lower, and even order
    lines of the last four days filed forty days too early."""
    old = rows.filter(F.col("order_date") <= F.lit(_CUT).cast("date"))
    moved = (F.col("order_date") >= F.date_sub(F.lit(_CUT).cast("date"), 3)) & (F.col("quantity") % 2 == 0)
    filed = F.when(moved, F.date_sub("order_date", 40)).otherwise(F.col("order_date"))
    return old.withColumns(
        {
            "sales_amount": (F.col("sales_amount") - 1).cast("decimal(18,2)"),
            "order_date": filed,
            "order_year_month": F.substring(filed.cast("string"), 1, 7),
        }
    ).sortWithinPartitions(fact.FACT_PARTITION, *fact.FACT_SORT)


def _two_batches(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    """The fact after two deliveries. The first has the orders up to the cut, but for every tenth, the second the
    rest; what the first run left was changed since, see ``_stored_before``."""
    settings = Settings(root=scratch_path(spark, "lake"), as_of=AS_OF)
    # Read for each delivery.
    feed = stash(raw(spark, sf_dir).sales, "feed", CODEC)
    number = F.substring("sls_ord_num", 3, 20).cast("bigint")
    early = (F.col("sls_order_dt") <= _CUT.replace("-", "")) & (number % 10 != 0)
    deliver = lambda rows: bronze.write_bronze(rows, settings.layer("bronze"), silver_sales.TABLE, "append")
    deliver(feed.filter(early))
    sides = warehouse.store_sides(clean(spark, sf_dir), settings)
    store = silver_sales.SalesStore(spark, settings)
    store.refresh()
    first = clean(spark, sf_dir)
    first.sales = store.read()
    stored = fact.fact_table(spark, f"{settings.layer('gold')}/fct_sales", repeats=True)
    lines = warehouse.fact_lines(first, sides.people, sides.lookup, by_month=True, whole=True)
    stored.overwrite(_stored_before(lines), placed=True)
    deliver(feed.filter(~early).withColumn("_batch_id", F.lit("b2")))
    warehouse.refresh_sales(stored, store, sides.people, sides.lookup, settings, late=late)
    return stored.read().drop("bronze_ingested_at")


@query
def fct_sales_incremental(spark, sf_dir):
    """Lookback upsert: recent rows corrected and new ones added, older ones left as they were."""
    return _two_batches(spark, sf_dir, late=False)


@query
def fct_sales_late_rows(spark, sf_dir):
    """The same, with the late lines of the second delivery that are older than the lookback window."""
    return _two_batches(spark, sf_dir, late=True)


@query
def dim_customers_from_history(spark, sf_dir):
    """The customers after two deliveries that share orders, with the order history kept between two refreshes."""
    settings = Settings(root=scratch_path(spark, "lake"), as_of=AS_OF)
    # Read for each delivery.
    feed = stash(raw(spark, sf_dir).sales, "feed", CODEC)
    second = F.crc32(F.concat_ws("|", "sls_ord_num", "sls_prd_key")) % 3 == 0
    sides = warehouse.store_sides(clean(spark, sf_dir), settings)
    store = silver_sales.SalesStore(spark, settings)
    history = customer_orders.OrderHistory(spark, settings, store)
    for part in (feed.filter(~second), feed.filter(second).withColumn("_batch_id", F.lit("b2"))):
        bronze.write_bronze(part, settings.layer("bronze"), silver_sales.TABLE, "append")
        store.refresh()
        history.refresh(sides.lookup)
    return dimensions.describe_customers(sides.people, history.read(sides.lookup), AS_OF)


@query
def replace_window(spark, sf_dir):
    """Delete-aware refresh: from the cut's month on exactly the source, without a third of its lines."""
    gold = Gold(spark, sf_dir)
    # Read for the fact and for the window.
    gold.clean.sales = stash(conform.without_measures(gold.clean.sales), "lines", CODEC)
    stored = fact.fact_table(spark, scratch_path(spark, "fact"))
    whole = gold.placed_fact.drop("bronze_ingested_at")
    fact.refresh_fact(stored, _stored_before(whole), SETTINGS.lookback_days, full=True, placed=True)
    # The fact again, not stored in between: of its lines only those of the window are joined.
    rows = gold.placed_fact.drop("bronze_ingested_at")
    fact.replace_recent(stored, rows.filter(F.col("quantity") % 3 != 0), dt.date(2001, 5, 15), placed=True)
    return stored.read()


def _customer_table(spark: SparkSession) -> versioned.VersionedTable:
    return versioned.VersionedTable(spark, scratch_path(spark, "customers"), "c_custkey", "nation")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))


@query
def upsert_schema_sync(spark, sf_dir):
    """Upsert whose updates have a new column and lack an old one: every customer is stored, updated or both."""
    customers = _customers(spark, sf_dir)
    stored = _customer_table(spark)
    stored.overwrite(customers.filter(F.col("c_custkey") % 3 != 0).select("c_custkey", "c_name", "c_acctbal", "c_nationkey", "nation"))
    changed = customers.filter((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 3 == 0))
    stored.upsert(changed.select("c_custkey", "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment", "nation"))
    return stored.read()


@query
def upsert_type_change(spark, sf_dir):
    """A code turns from text into a number and back, a number into text, while only some nations are rewritten."""
    customers = _customers(spark, sf_dir)
    padded = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    stored = _customer_table(spark)
    stored.overwrite(customers.select("c_custkey", padded.alias("code"), F.col("c_nationkey").cast("int").alias("zone"), "c_acctbal", "nation"))
    even = customers.filter(F.col("c_nationkey") % 2 == 0)
    named = F.concat(F.lit("Z"), F.col("c_nationkey").cast("string"))
    stored.upsert(even.select("c_custkey", (F.col("c_custkey") + 1).alias("code"), named.alias("zone"), "c_acctbal", "nation"))
    third = customers.filter(F.col("c_nationkey") % 3 == 0)
    coded = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    stored.upsert(third.select("c_custkey", coded.alias("code"), named.alias("zone"), F.col("c_acctbal").cast("string"), "nation"))
    return stored.read().withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query
def stale_keys(spark, sf_dir):
    """Stored lines that the source no longer has."""
    rows = fact_frame(spark, sf_dir).select("sales_line_id", "order_number", "quantity")
    return versioned.stale_keys(rows, rows.filter(F.col("quantity") % 5 != 0), "sales_line_id")


# --- end to end ------------------------------------------------------------------------------------

# A column of each gold table whose sum is compared.
_SUMMED = {
    "dim_dates": "date_year",
    "dim_products": "version_number",
    "dim_customers": "lifetime_sales_amount",
    "fct_sales": "sales_amount",
    "agg_kpi__monthly_performance": "gross_revenue",
    "agg_products__performance": "revenue_rank",
    "agg_products__category_rollup": "gross_revenue",
    "agg_customers__rfm_segmentation": "rfm_total_score",
}


def land_extracts(extracts, landing: str, tag: str) -> None:
    """The six extracts as CSV deliveries."""
    frames = ("customers", "products", "sales", "attributes", "geography", "categories")
    for spec, name in zip(sources(), frames, strict=True):
        rows = getattr(extracts, name).select(*spec.columns)
        rows.write.option("header", True).option("escape", '"').csv(f"{landing}/{spec.pattern.replace('*', tag)}")


@query
def warehouse_build(spark, sf_dir):
    """Six CSV deliveries to bronze, gold and marts; built in full, then refreshed. A row per gold table: what it
    holds, and how many rows the refresh changed."""
    base = scratch_path(spark, "warehouse")
    settings = Settings(root=f"{base}/lake", as_of=AS_OF)
    land_extracts(raw(spark, sf_dir), f"{base}/landing", "_1")
    bronze.assert_loaded(bronze.ingest_all(spark, f"{base}/landing", settings.layer("bronze"), batch_id="b1"))
    extracts = warehouse.BronzeExtracts(spark, settings)
    built = warehouse.build(spark, extracts, settings, full=True)
    facts = fact.fact_table(spark, f"{settings.layer('gold')}/fct_sales")
    version = facts.version()
    again = warehouse.build(spark, extracts, settings)
    rows = []
    for name, column in _SUMMED.items():
        counted = built[name].agg(
            F.lit(name).alias("gold_table"), F.count(F.lit(1)).alias("n_rows"), F.sum(column).cast("double").alias("total")
        )
        # Months of the fact that the refresh left alone are the same files: only the others are compared.
        differ = facts.changed(version) if name == "fct_sales" else again[name].exceptAll(built[name])
        changed = differ.agg(F.count(F.lit(1)).alias("n_changed"))
        rows.append(counted.withColumn("n_changed", changed.scalar()))
    return versioned.union_all(rows)


# --- marts -----------------------------------------------------------------------------------------


@query
def kpi_monthly(spark, sf_dir):
    return marts.kpi_monthly(fact_frame(spark, sf_dir))


@query
def kpi_monthly_calendar(spark, sf_dir):
    """Year-over-year by calendar month, on a fact without its Marches."""
    rows = fact_frame(spark, sf_dir).filter(F.col("order_month_number") != 3)
    return marts.kpi_monthly(rows, calendar=True)


@query
def product_abc(spark, sf_dir):
    gold = Gold(spark, sf_dir)
    return marts.product_performance(gold.fact, gold.items)


@query
def category_rollup(spark, sf_dir):
    return marts.category_rollup(Gold(spark, sf_dir).stored_fact(*marts.CATEGORY_COLUMNS))


@query
def category_report(spark, sf_dir):
    return marts.category_report(marts.category_rollup(Gold(spark, sf_dir).stored_fact(*marts.CATEGORY_COLUMNS)))


@query
def rfm_segments(spark, sf_dir):
    gold = Gold(spark, sf_dir)
    return marts.rfm_segments(gold.fact, gold.people, AS_OF)


@query
def rfm_segments_orders(spark, sf_dir):
    """Frequency as distinct orders instead of lines."""
    gold = Gold(spark, sf_dir)
    return marts.rfm_segments(gold.fact, gold.people, AS_OF, count_orders=True)


# --- global order ----------------------------------------------------------------------------------


@query
def global_ntile(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    by = [F.desc_nulls_last("c_acctbal"), F.asc_nulls_last("c_custkey")]
    wanted = ordering.Ordering(by, row_number="position", ntile={"fifth": 5, "seventh": 7})
    return ordering.rank_globally(customers, wanted)


@query
def global_cumsum(spark, sf_dir):
    """Running revenue of the line items in ship-date order."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    keys = ("ship_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price")
    wanted = ordering.Ordering(
        [F.asc_nulls_last(c) for c in keys],
        row_number="position",
        running_sum={"price_so_far": "price"},
        total={"price_total": "price"},
    )
    return ordering.rank_globally(lines, wanted)


@query
def global_dense_rank(spark, sf_dir):
    """Parts by size: fifty sizes for all parts, so ties cross the range borders."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    by = [F.desc_nulls_last("p_size"), F.asc_nulls_last("p_partkey")]
    wanted = ordering.Ordering(by, row_number="position", dense_rank={"size_rank": "p_size"})
    return ordering.rank_globally(parts, wanted)


# --- checks ----------------------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    sales = staging.typed_sales(raw(spark, sf_dir).sales)
    return quality.count_row_checks(sales, quality.not_null("order_number", "order_date", "sales_amount"))


@query
def dq_unique(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return quality.count_violations(lines, quality.unique("l_orderkey", "l_partkey", "l_suppkey"))


@query
def dq_unique_combo(spark, sf_dir):
    """Offending groups of the raw customer feed; the blank id is a group as well."""
    feed = raw(spark, sf_dir).customers.withColumn("cst_id", F.nullif(F.trim("cst_id"), F.lit("")))
    return quality.unique_combination("cst_id").offending(feed)


@query
def dq_accepted(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return versioned.union_all(
        [
            quality.count_violations(orders, [quality.accepted("o_orderstatus", ("F", "O"))]),
            quality.count_violations(lines, [quality.accepted("l_returnflag", ("A", "R"), "warn")]),
        ]
    )


@query
def dq_expression(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    wanted = [
        quality.expression("discount", "l_discount between 0 and 0.05"),
        quality.expression("price", "l_extendedprice > 0", "warn"),
    ]
    return quality.count_row_checks(lines, wanted)


@query
def dq_stored_failures(spark, sf_dir):
    """Offending rows of a failed check, read back from where the run stored them."""
    lines = table(spark, sf_dir, "lineitem")
    wanted = [quality.expression("quantity", "l_quantity < 40", "warn"), *quality.not_null("l_partkey")]
    store = scratch_path(spark, "checks")
    quality.run_checks({"lineitem": (lines, wanted)}, store)
    return spark.read.parquet(f"{store}/lineitem__expression_quantity").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )


@query
def dq_freshness(spark, sf_dir):
    """Age of the newest event of each type at a fixed moment."""
    events = table(spark, sf_dir, "events")
    now = dt.datetime(2024, 2, 1, 12)
    newest = events.groupBy("event_type").agg(F.max("ts").alias("ts"))
    overall = quality.freshness(newest, "ts", now, 24, 72)
    return overall.select("newest_at", F.round("age_hours", 6).alias("age_hours"), "status")


@query
def dq_reconcile(spark, sf_dir):
    gold = Gold(spark, sf_dir)
    return quality.reconcile(gold.fact, gold.clean.sales, "sales_line_id", "sales_amount", "quantity")


@query
def dq_ref_integrity(spark, sf_dir):
    return quality.referential_breaks(
        fact_frame(spark, sf_dir),
        "sales_line_id",
        {"missing_customer": "customer_sk", "missing_product": "product_sk"},
    )


@query
def dq_orphans(spark, sf_dir):
    """Orders of customers below the average balance, seen from a parent table that lacks them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer")
    rich = customers.filter(F.col("c_acctbal") >= 0)
    return quality.orphan_keys(orders, rich, "c_custkey").select("o_orderkey", "c_custkey")


@query
def dq_orphan_products(spark, sf_dir):
    """Products sold under a surrogate key that a dimension without road products lacks."""
    gold = Gold(spark, sf_dir)
    items = gold.items.filter(F.col("product_line") != "Road")
    sold = gold.fact.select("product_key", "product_sk")
    return quality.orphan_keys(sold, items, "product_sk").select("product_key").distinct()


@query
def dq_scd2(spark, sf_dir):
    """Window integrity of the event history, where several versions of a user start on one day."""
    return quality.version_breaks(scd2_events(spark, sf_dir), "user_id")


@query
def dq_country(spark, sf_dir):
    return quality.unmapped_codes(clean(spark, sf_dir).geography, "country")


@query
def dq_rejection_rate(spark, sf_dir):
    sales = raw(spark, sf_dir).sales
    return quality.rejection_rate(sales, staging.stg_sales(sales), SETTINGS.max_rejection_rate)


@query
def dq_rejection_rate_exceeded(spark, sf_dir):
    """Line items that ship before they are ordered count as rejected: far above the cap."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    # Two narrow columns shrink so much in an exchange that tasks sized by its bytes would sort millions of rows.
    tasks = layout.ranges_for(table(spark, sf_dir, "lineitem"), target_mb=8)
    dated = lines.repartition(tasks, "o_orderkey").join(orders.repartition(tasks, "o_orderkey"), "o_orderkey")
    kept = dated.filter(F.col("l_shipdate") >= F.col("o_orderdate"))
    return quality.rejection_rate(dated, kept, SETTINGS.max_rejection_rate)


@query
def dq_mart_reconcile(spark, sf_dir):
    gold = Gold(spark, sf_dir)
    rows = gold.stored_fact(*marts.MONTH_COLUMNS, *marts.PRODUCT_COLUMNS, *marts.CATEGORY_COLUMNS, *marts.ACTIVITY_COLUMNS)
    items, people = gold.items, stash(gold.people.select(*marts.BUYER_COLUMNS, "is_customer"), "customers")
    return checks.mart_gaps(
        rows,
        marts.kpi_monthly(rows),
        marts.product_performance(rows, items),
        marts.category_rollup(rows),
        marts.rfm_segments(rows, people, AS_OF),
    )


# --- ingest ----------------------------------------------------------------------------------------

CUSTOMER_SPEC = sources("crm")[0]


def _land(frame: DataFrame, landing: str, name: str) -> None:
    """Write rows as CSV files the way an extract arrives."""
    frame.write.option("header", True).option("escape", '"').csv(f"{landing}/source_crm/cust_info_{name}.csv")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_frame(spark, sf_dir, "raw_customers").select(*CUSTOMER_SPEC.columns)


def _parts(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The feed in two deliveries."""
    first = F.col("cst_marital_status") == "M"
    return feed.filter(first), feed.filter(~first)


def _folders(spark: SparkSession) -> tuple[str, str]:
    base = scratch_path(spark, "ingest")
    return f"{base}/landing", f"{base}/bronze"


def _loaded(spark: SparkSession, lake: str, *more: str) -> DataFrame:
    kept = [F.nullif(F.trim(c), F.lit("")).alias(c) for c in CUSTOMER_SPEC.columns]
    return bronze.read_bronze(spark, lake, CUSTOMER_SPEC.table).select(*kept, *more)


@query
def ingest_batch_lineage(spark, sf_dir):
    landing, lake = _folders(spark)
    _land(_feed(spark, sf_dir), landing, "a")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "overwrite", "b1", LOADED_AT)
    return _loaded(spark, lake, "_ingested_at", "_source_system", "_batch_id", RESCUED)


@query
def ingest_rescued(spark, sf_dir):
    """Every fourth customer's line carries a field too many, every fourth one too few."""
    landing, lake = _folders(spark)
    customers = table(spark, sf_dir, "customer")
    whole = F.concat_ws(
        ",", F.col("c_custkey").cast("string"), "c_name", F.lit("f"), F.lit("l"), F.lit("M"), F.lit("F"), F.lit("2010-10-06")
    )
    short = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.lit("f"))
    line = (
        F.when(F.col("c_custkey") % 4 == 1, F.concat(whole, F.lit(",extra")))
        .when(F.col("c_custkey") % 4 == 2, short)
        .otherwise(whole)
    )
    as_is = customers.select(line.alias(",".join(CUSTOMER_SPEC.columns)))
    # A separator that does not occur: the lines go out unquoted.
    as_is.write.option("header", True).option("sep", "\u0001").csv(f"{landing}/source_crm/cust_info_a.csv")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b1", LOADED_AT)
    return _loaded(spark, lake, RESCUED).select("cst_id", "cst_key", RESCUED)


@query
def ingest_header_gate(spark, sf_dir):
    """One delivery in another column order, one without a required column: the first loads by
    name, the second goes to quarantine."""
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    _land(first.select(*reversed(CUSTOMER_SPEC.columns)), landing, "a")
    _land(second.drop("cst_gndr"), landing, "b")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b1", LOADED_AT)
    found = headers.check_headers(spark, CUSTOMER_SPEC, landing)
    refused = found.filter(F.size("missing") > 0).select(F.concat_ws(",", "missing").alias("why")).distinct()
    good = _loaded(spark, lake).withColumn("note", F.lit("loaded"))
    bad = refused.select(*[F.lit(None).cast("string").alias(c) for c in CUSTOMER_SPEC.columns], F.col("why").alias("note"))
    return good.unionByName(bad)


@query
def ingest_quarantine(spark, sf_dir):
    """What a run over one system records when one extract's header lacks a column and the others
    have no delivery: every reason per table, and the rows of nothing else."""
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    _land(first, landing, "a")
    _land(second.drop("cst_key", "cst_gndr"), landing, "b")
    bronze.ingest_all(spark, landing, lake, "crm", batch_id="b1", loaded_at=LOADED_AT)
    log = bronze.read_log(spark, lake, "ingest_quarantine")
    refused = log.filter(F.col("_source_table") == CUSTOMER_SPEC.table).select("_source_table", "_reason").distinct()
    kept = bronze.read_bronze(spark, lake, CUSTOMER_SPEC.table).groupBy("_source_system").agg(F.count(F.lit(1)).alias("n"))
    return refused.select(F.col("_source_table").alias("what"), F.col("_reason").alias("value")).unionByName(
        kept.select(F.col("_source_system").alias("what"), F.col("n").cast("string").alias("value"))
    )


@query
def ingest_stream_once(spark, sf_dir):
    """Two runs over one landing folder, a delivery before each, and a third run with nothing new."""
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    checkpoints = scratch_path(spark, "stream")
    for part, name in ((first, "a"), (second, "b"), (None, "")):
        if part is not None:
            _land(part, landing, name)
        ingest_stream(spark, CUSTOMER_SPEC, landing, lake, checkpoints, files_per_trigger=100)
    # The id of the checkpoint differs from run to run; one checkpoint served both deliveries.
    loaded = _loaded(spark, lake, "_source_system", "_batch_id")
    return loaded.withColumn("_batch_id", F.regexp_replace("_batch_id", "^stream-.{36}-", "stream-"))


@query
def ingest_stream_two_checkpoints(spark, sf_dir):
    """Two landing folders, each with a checkpoint of its own, into one table: both deliveries stay."""
    lake = scratch_path(spark, "lake")
    for part, name in zip(_parts(_feed(spark, sf_dir)), ("a", "b"), strict=True):
        landing = scratch_path(spark, "landing")
        _land(part, landing, name)
        ingest_stream(spark, CUSTOMER_SPEC, landing, lake, scratch_path(spark, "stream"), files_per_trigger=100)
    return _loaded(spark, lake, "_source_system")


@query
def ingest_overwrite_then_append(spark, sf_dir):
    """A delivery appended, the table overwritten from another folder, the first delivery appended again."""
    landing, lake = _folders(spark)
    other = scratch_path(spark, "landing")
    first, second = _parts(_feed(spark, sf_dir))
    _land(first, landing, "a")
    _land(second, other, "b")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b1", LOADED_AT)
    bronze.load_batch(spark, CUSTOMER_SPEC, other, lake, "overwrite", "b2", LOADED_AT)
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b3", LOADED_AT)
    return _loaded(spark, lake, "_batch_id")


@query
def ingest_compact_then_append(spark, sf_dir):
    """A delivery compacted into a new place, where the same folder and a second delivery are appended."""
    landing, lake = _folders(spark)
    compacted = scratch_path(spark, "compacted")
    first, second = _parts(_feed(spark, sf_dir))
    _land(first, landing, "a")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b1", LOADED_AT)
    bronze.compact_bronze(spark, lake, compacted)
    _land(second, landing, "b")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, compacted, "append", "b2", LOADED_AT)
    return _loaded(spark, compacted, "_batch_id")


@query
def ingest_append_guard(spark, sf_dir):
    """The same landing folder loaded twice, then with a second delivery."""
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    _land(first, landing, "a")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b1", LOADED_AT)
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b2", LOADED_AT)
    _land(second, landing, "b")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b3", LOADED_AT)
    return _loaded(spark, lake, "_batch_id")


@query
def ingest_evolve(spark, sf_dir):
    """The second delivery brings an additional column."""
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    _land(first, landing, "a")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b1", LOADED_AT, keep_extra=True)
    _land(second.withColumn("cst_tier", F.concat(F.lit("t"), F.length("cst_key"))), landing, "b")
    bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", "b2", LOADED_AT, keep_extra=True)
    return _loaded(spark, lake, "cst_tier", "_batch_id")


@query
def ingest_audit(spark, sf_dir):
    """Audit of a run over one system, in which only one extract has a delivery."""
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    _land(first, landing, "a")
    bronze.ingest_all(spark, landing, lake, "crm", batch_id="b1", loaded_at=LOADED_AT)
    _land(second, landing, "b")
    bronze.ingest_all(spark, landing, lake, "crm", batch_id="b2", loaded_at=LOADED_AT)
    audit = bronze.read_log(spark, lake, "ingest_audit")
    totals = versioned.union_all(
        [
            bronze.audit_totals(audit, b).withColumn("batch_id", F.lit(b)).withColumnRenamed("_source_system", "system")
            for b in ("b1", "b2")
        ]
    )
    return totals.select("batch_id", "system", "rows_loaded")


@query
def ingest_summary(spark, sf_dir):
    landing, lake = _folders(spark)
    first, second = _parts(_feed(spark, sf_dir))
    for part, name, batch in ((first, "a", "b1"), (second, "b", "b2")):
        _land(part, landing, name)
        bronze.load_batch(spark, CUSTOMER_SPEC, landing, lake, "append", batch, LOADED_AT)
    loaded = bronze.read_bronze(spark, lake, CUSTOMER_SPEC.table)
    return bronze.summarise(loaded).drop("file_count")


# --- layout ----------------------------------------------------------------------------------------


@query
def compact_rows(spark, sf_dir):
    """Line items written as many small files, then compacted."""
    base = scratch_path(spark, "compact")
    table(spark, sf_dir, "lineitem").repartition(64).write.parquet(f"{base}/small")
    return layout.compact(spark, f"{base}/small", f"{base}/large")


@query
def clustered_layout(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    lines = table(spark, sf_dir, "lineitem")
    layout.write_clustered(lines, path, ["l_shipdate"], partition_by=["l_returnflag"])
    return spark.read.schema(lines.schema).parquet(path)


@query
def clustered_layout_two_keys(spark, sf_dir):
    """Line items in an interleaved order of day, supplier and return flag: filters on any of them skip files."""
    path = scratch_path(spark, "interleaved")
    lines = table(spark, sf_dir, "lineitem")
    layout.write_clustered(lines, path, ["l_shipdate", "l_suppkey", "l_returnflag"])
    return spark.read.schema(lines.schema).parquet(path)
