"""What crosses the network or is stored on the way to the fact and the category mart."""

import re

from pyspark.sql import functions as F

from silverlode.functions.text import packed_key
from silverlode.operators.versioned import VersionedTable
from silverlode.plans import conform, fact, marts, staging, warehouse
from silverlode.registry.raw_extracts import raw_frame
from silverlode.registry.spark_queries import Gold

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_lines_are_exchanged_once_for_their_group_and_their_order(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(raw_frame(spark, SF, "raw_sales"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    by_order = re.findall(r"hashpartitioning\(l_orderkey[^)]*\)", text)
    assert len(by_order) == 1 and "l_partkey" not in by_order[0]


def lines(spark):
    """Two months, an unknown customer (4) and an unknown product (P4)."""
    n = F.col("id")
    sales = spark.range(40).select(
        F.concat(F.lit("O"), (n % 10).cast("string")).alias("order_number"),
        F.concat(F.lit("P"), (n % 5).cast("string")).alias("product_key"),
        (n % 5).cast("int").alias("customer_id"),
        *[F.date_add(F.lit("2014-01-20").cast("date"), (n % 20).cast("int") + i).alias(c)
          for i, c in enumerate(("order_date", "ship_date", "due_date"))],
        F.lit(10).cast("decimal(18,2)").alias("sales_amount"),
        F.lit(1).alias("quantity"),
        F.lit(10).cast("decimal(18,2)").alias("unit_price"),
        F.current_timestamp().alias("bronze_ingested_at"),
    )
    text = F.concat(F.lit("T"), n.cast("string"))
    people = spark.range(4).select(
        n.cast("int").alias("customer_id"), F.concat(F.lit("K"), n.cast("string")).alias("customer_key"),
        *[text.alias(c) for c in ("customer_name", "gender", "marital_status", "age_band", "country")],
    )
    items = spark.range(4).select(
        F.concat(F.lit("P"), n.cast("string")).alias("product_key"), n.cast("int").alias("product_version_id"),
        F.lit(4).cast("decimal(12,2)").alias("product_cost"), F.lit(1).alias("product_version_count"),
        *[F.lit("2013-01-01").cast("date").alias(c) for c in ("product_start_date", "product_end_date")],
        *[text.alias(c) for c in ("product_name", "product_line", "category_id", "category_name", "subcategory_name")],
        F.lit(True).alias("requires_maintenance"), F.md5(text).alias("product_sk"),
    )
    clean = warehouse.Silver(None)
    clean.sales = sales.drop(*staging.sales_measures())
    return clean, conform.with_customer_sk(people), items


def test_fact_is_gathered_by_month_before_its_columns_are_derived(spark, rows, tmp_path):
    sides = lines(spark)
    whole, placed = warehouse.fact_lines(*sides), warehouse.fact_lines(*sides, by_month=True)
    columns = [c for c in whole.columns if c != "bronze_ingested_at"]
    assert placed.columns == whole.columns and rows(placed, *columns) == rows(whole, *columns)
    table = fact.fact_table(spark, str(tmp_path / "fact"))
    fact.refresh_fact(table, placed, 3, full=True, placed=True)
    assert rows(table.read(), *columns) == rows(whole, *columns)
    shuffles = [x for x in plan(placed).splitlines() if "Exchange hashpartitioning" in x]
    assert len([x for x in shuffles if "REBALANCE" in x]) == 1
    # One file for each of the two months, though nothing is gathered when it is written.
    assert sorted(len(list(p.glob("*.parquet"))) for p in (tmp_path / "fact/data/load=1").glob("*=*")) == [1, 1]
    below = plan(placed).split("REBALANCE", 1)
    assert "md5" in below[0] and "customer_sk" not in below[1]


def test_labels_travel_as_numbers_and_give_the_same_fact(spark, rows):
    clean, people, items = lines(spark)
    items = items.drop("product_sk").withColumn("product_valid_from", F.col("product_start_date"))
    people = people.withColumn("country", F.when(F.col("customer_id") != 2, F.col("country")))
    plain, coded = warehouse.fact_lines(clean, people, items), warehouse.fact_lines(clean, people, items, by_month=True, whole=True)
    columns = [c for c in plain.columns if c != "bronze_ingested_at"]
    assert coded.columns == plain.columns and rows(coded, *columns) == rows(plain, *columns)
    assert plain.filter("product_sk is null").select("product_key").distinct().collect() == [("P4",)]
    below = plan(coded).split("REBALANCE", 1)[1].split("Exchange")[0]
    assert "_customer_labels" in below and "customer_country" not in below and "subcategory_name" not in below


def test_many_labels_are_left_alone(spark, monkeypatch):
    _, people, _ = lines(spark)
    monkeypatch.setattr(conform, "_MOST_LABELS", 3)
    side, labels = conform.number_labels(people, conform.CUSTOMER_LABELS, "n")
    assert labels is None and side.columns == people.columns
    monkeypatch.setattr(conform, "_MOST_LABELS", 4)
    side, labels = conform.number_labels(people, conform.CUSTOMER_LABELS, "n")
    assert labels.rows.count() == side.select("n").distinct().count() == 4 and "country" not in side.columns


def test_window_rows_are_derived_once(spark, rows, tmp_path):
    """The rows of a window are asked for their months and then stored."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = VersionedTable(spark, str(tmp_path / "t"), "k", "m")
    table.overwrite(spark.sql("select 'a' as k, '2014-01' as m union all select 'b', '2014-02'"))
    new = spark.sql("select 'c' as k, '2014-02' as m union all select 'd', '2014-03'").mapInArrow(count, "k string, m string")
    table.replace_window(new, F.col("m") >= "2014-02", F.col("m") >= "2014-02")
    assert rows(table.read(), "k", "m") == [("a", "2014-01"), ("c", "2014-02"), ("d", "2014-03")]
    assert seen.value == 2


def test_packed_keys_are_as_many_as_texts(spark):
    texts = ["a" * 32, "A" * 32, "a" * 32 + "\n", "a" * 31, "", "ª", "ª" * 16, "|" * 17, bytes(range(65, 81)).decode(), bytes(range(65, 81)).hex(), None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.agg(F.countDistinct("t"), F.countDistinct(packed_key("t"))).first() == (10, 10)
    assert df.filter("t is null").select(packed_key("t")).first()[0] is None
    assert df.filter(F.length(packed_key("t")) == 16).count() == 2


def test_category_mart_counts_by_number_and_packed_key(spark):
    clean, people, items = lines(spark)
    rolled = marts.category_rollup(warehouse.fact_lines(clean, people, items))
    found = {r.category_id: (r.order_count, r.buyer_count, r.product_count, r.order_line_count) for r in rolled.collect()}
    assert found == {**{f"T{i}": (2, 1, 1, 8) for i in range(4)}, "UNCLASSIFIED": (2, 0, 1, 8)}
    facts = warehouse.fact_lines(clean, people, items)
    numbers = marts._classified(facts).select(*marts.CATEGORY_GRAIN).distinct().withColumn("grain_number", F.monotonically_increasing_id())
    text = plan(marts.category_sums(facts, numbers))
    assert "HashAggregate(keys=[grain_number" in text.split("Expand")[0] and "[category_id" not in text.split("Expand")[0]


def test_stored_fact_has_no_derived_customer_keys(spark, rows):
    gold = Gold(spark, SF)
    stored, whole = gold.stored_fact(*marts.CATEGORY_COLUMNS), gold.fact.select(*marts.CATEGORY_COLUMNS)
    scan = [x for x in plan(stored).splitlines() if "FileScan" in x]
    assert len(scan) == 1 and "customer_key" in scan[0] and "customer_sk" not in scan[0]
    assert stored.columns == whole.columns and rows(stored) == rows(whole)


def test_fact_is_sorted_before_its_columns_are_derived(spark, tmp_path):
    placed = warehouse.fact_lines(*lines(spark), by_month=True, whole=True)
    above, below = plan(placed).split("Sort [_month", 1)
    assert "md5" in above and "customer_sk" not in below and "days_to_ship" not in below
    table = fact.fact_table(spark, str(tmp_path / "fact"), repeats=True)
    table.overwrite(placed, fact.FACT_SORT, placed=True)
    for file in (tmp_path / "fact/data/load=1").glob("*=*/*.parquet"):
        found = [(r.order_date, r.sales_line_id) for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found) and len(found) > 1


def test_window_of_the_fact_is_placed_like_a_whole_one(spark, rows, tmp_path):
    clean, people, items = lines(spark)
    placed = warehouse.fact_lines(clean, people, items, by_month=True, whole=True)
    table = fact.fact_table(spark, str(tmp_path / "fact"), repeats=True)
    table.overwrite(placed.withColumn("quantity", F.col("quantity") + 1), placed=True)
    fact.replace_recent(table, placed.filter("product_key != 'P1'"), "2014-02-05", placed=True)
    got = rows(table.read(), "order_date", "product_key", "quantity")
    # A line has quantity 1, one that was there before 2.
    want = [(r[0], r[1], 2) for r in rows(placed, "order_date", "product_key") if f"{r[0]}" < "2014-02-05"]
    want += [(r[0], r[1], 1) for r in rows(placed, "order_date", "product_key") if f"{r[0]}" >= "2014-02-05" and r[1] != "P1"]
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t)) and 0 < len(want) < 40
