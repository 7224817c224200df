import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import versioned
from silverlode.plans import fact
from silverlode.session import scratch_path

SCHEMA = "sales_line_id string, order_date date, order_year_month string, v int"


def frame(spark, *items):
    data = [(k, dt.date.fromisoformat(d), d[:7], v) for k, d, v in items]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def stored(spark):
    return fact.fact_table(spark, scratch_path(spark, "test-fact"))


def content(table):
    return sorted((r.sales_line_id, str(r.order_date), r.order_year_month, r.v) for r in table.read().collect())


def test_upsert(spark, stored):
    stored.upsert(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1), ("c", "2014-03-05", 1)))
    updates = frame(spark, ("b", "2014-02-05", 2), ("d", "2014-02-07", 2))
    stored.upsert(updates)
    want = [("a", "2014-01-05", "2014-01", 1), ("b", "2014-02-05", "2014-02", 2), ("c", "2014-03-05", "2014-03", 1), ("d", "2014-02-07", "2014-02", 2)]
    assert content(stored) == want
    stored.upsert(updates)
    assert content(stored) == want


def test_only_touched_partitions_are_written(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1)))
    version = stored.upsert(frame(spark, ("b", "2014-02-05", 2)))
    assert stored._holders(version) == {"order_year_month=2014-01": 1, "order_year_month=2014-02": version}


def test_restated_date_moves_the_row(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-01-06", 1), ("c", "2014-05-01", 1)))
    stored.upsert(frame(spark, ("a", "2014-02-05", 2)))
    assert content(stored) == [("a", "2014-02-05", "2014-02", 2), ("b", "2014-01-06", "2014-01", 1), ("c", "2014-05-01", "2014-05", 1)]
    stored.upsert(frame(spark, ("b", "2014-02-06", 2)))  # leaves its old partition empty
    assert content(stored) == [("a", "2014-02-05", "2014-02", 2), ("b", "2014-02-06", "2014-02", 2), ("c", "2014-05-01", "2014-05", 1)]


def test_repeated_update_key_is_an_error(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1)))
    with pytest.raises(versioned.DuplicateKeyError):
        stored.upsert(frame(spark, ("b", "2014-01-05", 1), ("b", "2014-01-06", 2)))
    assert content(stored) == [("a", "2014-01-05", "2014-01", 1)]


def test_repeated_ids_are_replaced_together_where_they_are_allowed(spark):
    table = fact.fact_table(spark, scratch_path(spark, "test-fact"), repeats=True)
    table.upsert(frame(spark, ("a", "2014-01-05", 1), ("a", "2014-01-05", 1), ("b", "2014-01-05", 1), ("c", "2014-02-05", 1)))
    table.upsert(frame(spark, ("a", "2014-01-05", 2), ("a", "2014-01-05", 3), ("d", "2014-01-06", 2)))
    assert content(table) == [
        ("a", "2014-01-05", "2014-01", 2), ("a", "2014-01-05", "2014-01", 3), ("b", "2014-01-05", "2014-01", 1),
        ("c", "2014-02-05", "2014-02", 1), ("d", "2014-01-06", "2014-01", 2),
    ]


def test_changed_rows_read_rewritten_partitions_only(spark, stored):
    first = stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1), ("e", "2014-02-05", 1)))
    assert stored.changed(first).count() == 0
    stored.upsert(frame(spark, ("b", "2014-02-05", 2), ("d", "2014-03-07", 2)))
    changed = stored.changed(first)
    assert sorted((r.sales_line_id, r.v) for r in changed.collect()) == [("b", 2), ("d", 2)]
    assert not any("2014-01" in path for path in changed.inputFiles())


def test_empty_target_and_empty_updates(spark, stored):
    assert stored.read() is None
    stored.upsert(frame(spark, ("a", "2014-01-05", 1)))
    stored.upsert(frame(spark, ("a", "2014-01-05", 1)).limit(0))
    assert content(stored) == [("a", "2014-01-05", "2014-01", 1)]


def test_older_versions_stay_readable(spark, stored):
    first = stored.overwrite(frame(spark, ("a", "2014-01-05", 1)))
    stored.overwrite(frame(spark, ("a", "2014-01-05", 2)))
    assert [r.v for r in stored.read(first).collect()] == [1]
    assert [r.v for r in stored.read().collect()] == [2]


def test_failed_commit_is_invisible(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1)))
    number = stored._next()
    stored._write_rows(frame(spark, ("z", "2014-01-05", 9)), number, [])  # dies before publishing
    assert content(stored) == [("a", "2014-01-05", "2014-01", 1)]
    stored.upsert(frame(spark, ("b", "2014-01-06", 1)))
    assert content(stored) == [("a", "2014-01-05", "2014-01", 1), ("b", "2014-01-06", "2014-01", 1)]


def test_null_partition_value(spark, stored):
    rows = frame(spark, ("a", "2014-01-05", 1), ("b", "2014-01-06", 1))
    rows = rows.withColumn("order_year_month", F.when(F.col("sales_line_id") != "b", F.col("order_year_month")))
    stored.overwrite(rows)
    stored.upsert(rows.withColumn("v", F.lit(3)))
    assert sorted((r.sales_line_id, r.order_year_month, r.v) for r in stored.read().collect()) == [("a", "2014-01", 3), ("b", None, 3)]


def test_lookback_is_inclusive(spark, stored):
    target = frame(spark, ("a", "2014-01-28", 1))
    source = frame(spark, ("x", "2014-01-24", 1), ("y", "2014-01-25", 1), ("z", "2014-02-01", 1))
    assert sorted(r[0] for r in versioned.lookback(source, target, "order_date", 3).collect()) == ["y", "z"]
    assert versioned.lookback(source, target.limit(0), "order_date", 3).count() == 3
    assert versioned.lookback(source, None, "order_date", 3).count() == 3


def test_late_rows_inside_the_window_only(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-10", 1), ("b", "2014-01-28", 1)))
    source = frame(spark, ("a", "2014-01-10", 2), ("b", "2014-01-28", 2), ("c", "2014-01-26", 2), ("d", "2014-01-11", 2))
    fact.refresh_fact(stored, source, 3)
    assert [(k, v) for k, _, _, v in content(stored)] == [("a", 1), ("b", 2), ("c", 2)]
    fact.refresh_fact(stored, source, 3, full=True)
    assert [(k, v) for k, _, _, v in content(stored)] == [("a", 2), ("b", 2), ("c", 2), ("d", 2)]


def test_incremental_equals_full_when_nothing_is_stale(spark, stored):
    source = frame(spark, *[(f"k{i}", f"2014-0{1 + i % 5}-1{i % 7}", i) for i in range(40)])
    fact.refresh_fact(stored, source.filter("order_date <= '2014-04-12'"), 3, full=True)
    fact.refresh_fact(stored, source, 3)
    assert content(stored) == sorted((r[0], str(r[1]), r[2], r[3]) for r in source.collect())


def test_stale_rows_stay_until_replaced(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-10", 1), ("gone", "2014-01-20", 1), ("b", "2014-02-01", 1)))
    source = frame(spark, ("a", "2014-01-10", 1), ("b", "2014-02-01", 2))
    fact.refresh_fact(stored, source, 30)
    assert [k for k, *_ in content(stored)] == ["a", "b", "gone"]
    assert [r[0] for r in versioned.stale_keys(stored.read(), source, "sales_line_id").select("sales_line_id").collect()] == ["gone"]
    fact.replace_recent(stored, source, dt.date(2014, 1, 15))
    assert [k for k, *_ in content(stored)] == ["a", "b"]


def test_schema_sync(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1)))
    changed = frame(spark, ("b", "2014-02-05", 2)).drop("v").withColumn("w", F.lit("new"))
    stored.upsert(changed)
    assert sorted(stored.read().columns) == ["order_date", "order_year_month", "sales_line_id", "w"]
    assert sorted((r.sales_line_id, r.w) for r in stored.read().collect()) == [("a", None), ("b", "new")]


def typed(spark, schema, *items):
    return spark.createDataFrame(list(items), f"sales_line_id string, order_year_month string, {schema}")


def kept(table, *columns):
    return sorted(tuple(r) for r in table.read().select("sales_line_id", *columns).collect())


def test_types_may_change_both_ways(spark, stored):
    stored.overwrite(typed(spark, "v int, w string", ("a", "2014-01", 1, "07"), ("b", "2014-02", 2, " 8"), ("c", "2014-03", None, None)))
    stored.upsert(typed(spark, "v string, w int", ("b", "2014-02", "x", 9)))
    assert dict(stored.read().dtypes) == {"sales_line_id": "string", "order_year_month": "string", "v": "string", "w": "int"}
    assert kept(stored, "v", "w") == [("a", "1", 7), ("b", "x", 9), ("c", None, None)]
    # Back to text: what was read as a number stays one, whether or not its folder was rewritten.
    stored.upsert(typed(spark, "w string", ("c", "2014-03", "z")))
    assert kept(stored, "w") == [("a", "7"), ("b", "9"), ("c", "z")]
    # A name that returns is a new column.
    stored.upsert(typed(spark, "w string, v string", ("d", "2014-03", "z", "n")))
    assert kept(stored, "v", "w") == [("a", None, "7"), ("b", None, "9"), ("c", None, "z"), ("d", "n", "z")]
    assert kept(stored, "v") == sorted((r.sales_line_id, r.v) for p in ("01", "02", "03") for r in stored.read().filter(f"order_year_month = '2014-{p}'").collect())


def test_values_that_would_be_lost_stop_the_commit(spark, stored):
    stored.overwrite(typed(spark, "v string, w double", ("a", "2014-01", "seven", 1.5), ("b", "2014-02", "8", 2.0)))
    before = stored.version()
    with pytest.raises(versioned.SchemaChangeError, match="1 stored values of v"):
        stored.upsert(typed(spark, "v int, w double", ("b", "2014-02", 1, 2.0)))
    with pytest.raises(versioned.SchemaChangeError, match="of w do not survive the change from double to int"):
        stored.upsert(typed(spark, "v string, w int", ("b", "2014-02", "1", 2)))
    assert stored.version() == before and kept(stored, "v", "w") == [("a", "seven", 1.5), ("b", "8", 2.0)]
    stored.overwrite(typed(spark, "v int, w int", ("b", "2014-02", 1, 2)))
    assert kept(stored, "v", "w") == [("b", 1, 2)]


def test_listing_without_schemas_is_readable(spark, stored):
    """A table written before schemas were kept."""
    stored.overwrite(typed(spark, "v int", ("a", "2014-01", 1), ("b", "2014-02", 2)))
    version = stored.upsert(typed(spark, "v int, w int", ("b", "2014-02", 3, 4)))
    old = spark.read.parquet(f"{stored.path}/versions/v={version}").drop("schemas").collect()
    spark.createDataFrame(old, "load bigint, part string").coalesce(1).write.mode("overwrite").parquet(f"{stored.path}/versions/v={version}")
    assert kept(stored, "v", "w") == [("a", 1, None), ("b", 3, 4)]
    stored.upsert(typed(spark, "v string, w int", ("b", "2014-02", "5", 6)))
    assert kept(stored, "v", "w") == [("a", "1", None), ("b", "5", 6)]


def test_partition_filter_prunes_folders(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1)))
    plan = stored.read().filter("order_year_month = '2014-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year_month" in plan


def test_key_range_reaches_the_scan(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1)))
    text = stored._holding(stored.read(), frame(spark, ("b", "2014-03-05", 2)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sales_line_id,b)" in text and "ReadSchema: struct<sales_line_id:string>" in text


def test_partition_names_with_special_characters(spark):
    table = versioned.VersionedTable(spark, scratch_path(spark, "odd"), "k", "p")
    rows = spark.createDataFrame([("a", "x:1/2 %", 1), ("b", "y=ü", 1)], "k string, p string, v int")
    table.overwrite(rows)
    table.upsert(rows.filter("k = 'a'").withColumn("v", F.lit(2)))
    assert sorted(map(tuple, table.read().select("k", "p", "v").collect())) == [("a", "x:1/2 %", 2), ("b", "y=ü", 1)]


def test_new_rows_lie_beside_the_old_ones(spark, stored):
    first = stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-02-05", 1)))
    second = stored.upsert(frame(spark, ("c", "2014-01-06", 2), ("d", "2014-03-01", 2)))
    january, february, march = (f"order_year_month=2014-0{m}" for m in (1, 2, 3))
    assert stored._loads(second) == {january: (first, second), february: (first,), march: (second,)}
    assert sorted(r[0] for r in stored.changed(first).select("sales_line_id").collect()) == ["c", "d"]
    assert not any(f"load={first}/" in path for path in stored.changed(first).inputFiles())
    # A replaced row: its partition is rewritten, from both loads.
    third = stored.upsert(frame(spark, ("a", "2014-01-05", 3)))
    assert stored._loads(third) == {january: (third,), february: (first,), march: (second,)}
    assert [(k, v) for k, _, _, v in content(stored)] == [("a", 3), ("b", 1), ("c", 2), ("d", 2)]
    assert [(r.sales_line_id, r.v) for r in stored.changed(second).collect()] == [("a", 3)]
    assert sorted(r.sales_line_id for r in stored.read(second).collect()) == ["a", "b", "c", "d"]


def test_a_partition_of_many_loads_is_rewritten(spark, stored, monkeypatch):
    monkeypatch.setattr(versioned, "_MOST_LOADS", 2)
    for k in "abc":
        version = stored.upsert(frame(spark, (k, "2014-01-05", 1)))
    assert stored._loads(version) == {"order_year_month=2014-01": (version,)}
    assert [k for k, *_ in content(stored)] == ["a", "b", "c"]


def test_a_type_changes_beside_loads_of_the_old_type(spark, stored):
    stored.overwrite(typed(spark, "v int", ("a", "2014-01", 1)))
    stored.upsert(typed(spark, "v string", ("b", "2014-01", "x")))
    stored.upsert(typed(spark, "v string, w int", ("c", "2014-01", "y", 2)))
    assert kept(stored, "v", "w") == [("a", "1", None), ("b", "x", None), ("c", "y", 2)]


def test_a_window_becomes_its_rows_over_several_loads(spark, stored):
    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-01-20", 1)))
    stored.upsert(frame(spark, ("c", "2014-01-06", 1), ("d", "2014-01-21", 1), ("e", "2014-03-01", 1)))
    fact.replace_recent(stored, frame(spark, ("b", "2014-01-20", 2), ("f", "2014-02-01", 2)), dt.date(2014, 1, 15))
    assert [(k, v) for k, _, _, v in content(stored)] == [("a", 1), ("b", 2), ("c", 1), ("f", 2)]


def test_updates_are_derived_once(spark, stored):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stored.overwrite(frame(spark, ("a", "2014-01-05", 1), ("b", "2014-01-20", 1)))
    stored.upsert(frame(spark, ("a", "2014-02-05", 2), ("c", "2014-02-06", 2)).mapInArrow(count, SCHEMA))
    assert seen.value == 2 and [(k, v) for k, _, _, v in content(stored)] == [("a", 2), ("b", 1), ("c", 2)]
