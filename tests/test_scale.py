"""Plans and results on skewed data: a third of all lines belongs to one customer and one product."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import dedup
from silverlode.plans import conform
from silverlode.session import stash

LINES = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    n = F.col("id")
    hot = n % 3 == 0
    sales = spark.range(LINES).select(
        F.concat(F.lit("O"), (n / 4).cast("int").cast("string"), F.lit("-"), n.cast("string")).alias("order_number"),
        F.when(hot, "P7").otherwise(F.concat(F.lit("P"), (n % 900).cast("string"))).alias("product_key"),
        F.when(hot, 11).otherwise((n % 2000).cast("int")).alias("customer_id"),
        *[F.lit(dt.date(2014, 1, 1)).alias(d) for d in ("order_date", "ship_date", "due_date")],
        *[F.lit(0).alias(d) for d in ("days_to_ship", "days_to_due", "days_in_transit")],
        F.lit(10).cast("decimal(18,2)").alias("sales_amount"),
        F.lit(1).alias("quantity"),
        *[F.lit(10).cast("decimal(18,2)").alias(c) for c in ("unit_price", "discount_amount", "realised_unit_price")],
        F.lit(dt.datetime(2026, 1, 1)).alias("bronze_ingested_at"),
    )
    text = F.sha2(n.cast("string"), 512)
    people = spark.range(1900).select(
        n.cast("int").alias("customer_id"), F.concat(F.lit("K"), n.cast("string")).alias("customer_key"),
        *[text.alias(c) for c in ("customer_name", "gender", "marital_status", "age_band", "country")],
    )
    items = spark.range(880).select(
        F.concat(F.lit("P"), n.cast("string")).alias("product_key"), n.cast("int").alias("product_version_id"),
        F.lit(4).cast("decimal(12,2)").alias("product_cost"), F.lit(1).alias("product_version_count"),
        *[F.lit(dt.date(2013, 1, 1)).alias(c) for c in ("product_start_date", "product_end_date")],
        *[text.alias(c) for c in ("product_name", "product_line", "category_id", "category_name", "subcategory_name")],
        F.lit(True).alias("requires_maintenance"),
    )
    return stash(sales.repartition(8), "sales"), stash(people, "people"), stash(items, "items")


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def tiny_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_skewed_joins_are_split_and_complete(spark, skewed, tiny_partitions):
    enriched = conform.enrich_sales(*skewed)
    got = enriched.groupBy().agg(
        F.count(F.lit(1)), F.count("customer_key"), F.count("product_version_id"), F.countDistinct("sales_line_id")
    )
    sales, *_ = skewed
    known = sales.filter("customer_id < 1900").count()
    sold = sales.filter("int(substr(product_key, 2)) < 880").count()
    assert tuple(got.first()) == (LINES, known, sold, LINES)
    enriched.select(F.sum(F.hash(*enriched.columns).cast("bigint"))).collect()
    query = enriched._jdf.queryExecution()
    query.toRdd().count()
    assert "isSkew=true" in query.executedPlan().toString() or "skew=true" in query.executedPlan().toString()


def test_measures_and_customer_keys_do_not_travel_through_the_joins(spark, skewed):
    from silverlode.plans import staging, warehouse

    sales, people, items = skewed
    clean = warehouse.Silver(None)
    clean.sales = sales.drop(*staging.sales_measures())
    items = items.withColumn("product_sk", F.md5("product_key"))
    built = warehouse.fact_lines(clean, conform.with_customer_sk(people), items)
    derived = ("days_to_ship", "days_to_due", "days_in_transit", "discount_amount", "realised_unit_price")
    assert [tuple(map(float, r)) for r in built.select(*derived).distinct().collect()] == [(0, 0, 0, 0, 10)]
    keys = conform.with_customer_sk(people).select("customer_id", F.col("customer_sk").alias("known"))
    found = built.join(keys, "customer_id", "left")
    assert found.filter(~F.col("customer_sk").eqNullSafe(F.col("known"))).count() == 0
    assert found.filter("customer_sk is null").count() == sales.filter("customer_id >= 1900").count()
    with_own = conform.enrich_sales(sales, people, items)
    assert with_own.select("discount_amount").distinct().first()[0] == 10  # measures that lines have are kept


def test_narrow_joins_are_spread_by_the_bytes_of_the_table(spark):
    from silverlode.registry.spark_queries import QUERIES

    checked = QUERIES["dq_rejection_rate_exceeded"](spark, "/root/testdata/sf0.001")
    # Not merged into few tasks by the small size of what is exchanged.
    assert checked._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 2


def test_hot_key_sends_one_row_per_task_to_the_dedup(spark, skewed):
    """Sixty thousand rows of one key: the exchange carries one row per input partition."""
    sales, *_ = skewed
    latest = dedup.dedup_latest(sales, ["quantity"], [F.col("order_number").desc()])  # one value
    query = latest._jdf.queryExecution()
    assert query.toRdd().count() == 1
    plan = query.executedPlan().toString()
    assert "WindowGroupLimit" in plan
    stage = plan[plan.index("ShuffleQueryStage") :]
    assert "Partial" in stage


def test_rollup_combines_before_the_exchange(spark, skewed):
    from silverlode.plans.dimensions import order_rollup

    sales, *_ = skewed
    rolled = order_rollup(sales.withColumn("gross_margin", F.lit(1).cast("decimal(18,2)")))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 3 and "partial_sum" in plan
    assert rolled.filter("customer_id = 11").first().order_line_count > LINES // 3
