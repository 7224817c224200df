import datetime as dt

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from silverlode.operators import dedup, layout, ordering, reject, scd, sequence
from silverlode.session import scratch_path, stash

D = dt.date


def test_dedup_order_of_preference(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "2020-01-01", "a", None, 1), (1, "2020-01-01", "a", "b", 1),  # fuller record
            (2, "2020-01-01", "x", "y", 1), (2, "2020-01-02", None, None, 1),  # newer date
            (3, None, "n", "n", 1), (3, "1900-01-02", None, None, 1),  # no date counts as the oldest
            (4, "2020-01-01", "old", "z", 1), (4, "2020-01-01", "new", "z", 2),  # later load
        ],
        "k int, d string, f string, l string, load int",
    )
    order = [
        F.coalesce(F.col("d"), F.lit("1900-01-01")).desc(),
        dedup.completeness({"f": 8, "l": 4}).desc(),
        F.desc_nulls_last("load"),
    ]
    got = rows(dedup.dedup_latest(df, ["k"], order), "k", "d", "f", "l")
    assert got == [(1, "2020-01-01", "a", "b"), (2, "2020-01-02", None, None), (3, "1900-01-02", None, None), (4, "2020-01-01", "new", "z")]


def test_dedup_is_deterministic_on_ties(spark, rows):
    data = [(1, "x", i) for i in range(50)]
    one = dedup.dedup_latest(spark.createDataFrame(data, "k int, a string, v int"), ["k"], [F.col("a").desc()])
    two = dedup.dedup_latest(spark.createDataFrame(data[::-1], "k int, a string, v int").repartition(7), ["k"], [F.col("a").desc()])
    assert rows(one) == rows(two)


def test_dedup_limits_rows_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.dedup_latest(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pick_version(spark, rows):
    df = spark.createDataFrame(
        [("p", 1, False, D(2013, 1, 1)), ("p", 2, True, D(2011, 1, 1)), ("p", 3, True, D(2012, 1, 1)), ("p", 4, True, D(2012, 1, 1)), ("q", 5, False, None)],
        "k string, id int, open boolean, start date",
    )
    got = dedup.pick_version(df, "k", ["open", "start", "id"], count_as="n")
    assert rows(got, "k", "id", "n") == [("p", 4, 4), ("q", 5, 1)]


def test_split_valid_covers_all_rows(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None), (None, -2)], "a int, b int")
    rules = {"a_missing": F.col("a").isNotNull(), "b_bad": F.col("b") > 0}
    valid, bad = reject.split_valid(df, rules)
    assert rows(valid) == [(1, 5)]
    assert rows(bad, "a", "reasons") == [(2, ["b_bad"]), (3, ["b_bad"]), (None, ["a_missing", "b_bad"])]
    assert rows(reject.count_by_reason(bad)) == [("a_missing", 1), ("b_bad", 3)]


def _versions(spark):
    return spark.createDataFrame(
        [("p", 1, D(2011, 7, 1)), ("p", 2, D(2012, 7, 1)), ("p", 3, D(2013, 7, 1)), ("q", 4, D(2011, 7, 1)), (None, 5, D(2011, 7, 1)), (None, 6, D(2011, 7, 2))],
        "k string, id int, start date",
    )


def test_scd2(spark, rows):
    got = scd.scd2(_versions(spark), "k", "start", "id")
    end = D(9999, 12, 31)
    assert rows(got, "k", "version_number", "valid_from_date", "valid_to_date", "is_current", "version_count") == [
        ("p", 1, D(2011, 7, 1), D(2012, 6, 30), False, 3),
        ("p", 2, D(2012, 7, 1), D(2013, 6, 30), False, 3),
        ("p", 3, D(2013, 7, 1), end, True, 3),
        ("q", 1, D(2011, 7, 1), end, True, 1),
        (None, 1, D(2011, 7, 1), D(2011, 7, 1), False, 2),
        (None, 2, D(2011, 7, 2), end, True, 2),
    ]


def test_scd2_of_a_hot_key_equals_the_plain_window(spark, rows):
    """Two thirds of the rows belong to one key, with many equal dates."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        "id",
        F.date_add(F.lit(D(2000, 1, 1)), (F.col("id") % 700).cast("int")).alias("start"),
    )
    by_key = W.partitionBy("k")
    plain = df.select(
        "*",
        F.row_number().over(by_key.orderBy("start", "id")).alias("n"),
        F.count("id").over(by_key).alias("c"),
        F.lead("start").over(by_key.orderBy("start", "id")).alias("x"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = sequence.number_in_key(df, "k", ["start", "id"], "n", "c", ("start", "x"), heavy_rows=100, ranges=8)
        assert rows(spread.select(plain.columns)) == rows(plain)
        ranges = sequence.sorted_ranges(df, "k", ["start", "id"], ranges=8).groupBy("_seq_part", "k").count()
        of_hot = [r["count"] for r in ranges.filter("k = 'hot'").collect()]
        assert len(of_hot) >= 5 and max(of_hot) < 1500 and sum(of_hot) == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_history_of_no_rows(spark):
    assert scd.scd2(_versions(spark).limit(0), "k", "start", "id").count() == 0


def test_scd2_tiles_the_timeline(spark):
    got = scd.scd2(_versions(spark).dropna(), "k", "start", "id").orderBy("k", "version_number").collect()
    for a, b in zip(got, got[1:]):
        if a.k == b.k:
            assert a.valid_to_date + dt.timedelta(days=1) == b.valid_from_date


def _values(spark, n):
    return spark.range(n).select(
        "id", (F.col("id") * 7919 % 13).cast("int").alias("v"), F.when(F.col("id") % 5 != 0, F.col("id") % 11).alias("w")
    )


def _ranked(df):
    by = ordering.Ordering(
        [F.desc_nulls_last("v"), F.asc_nulls_last("id")],
        row_number="rn",
        ntile={"five": 5, "many": 1000},
        dense_rank={"dense": "v"},
        running_sum={"so_far": "w"},
        total={"all_of_it": "w"},
    )
    return ordering.rank_globally(df, by)


def _in_one_task(df):
    """The same by windows over the whole table."""
    along = W.orderBy(F.desc_nulls_last("v"), F.asc_nulls_last("id"))
    return df.select(
        "*",
        F.row_number().over(along).alias("rn"),
        F.ntile(5).over(along).alias("five"),
        F.ntile(1000).over(along).alias("many"),
        F.dense_rank().over(W.orderBy(F.desc_nulls_last("v"))).alias("dense"),
        F.sum("w").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("so_far"),
        F.sum("w").over(W.partitionBy()).alias("all_of_it"),
    )


@pytest.mark.parametrize("n", [1, 7, 5003])
def test_distributed_order_equals_single_task_windows(spark, rows, n):
    plain = _in_one_task(_values(spark, n))
    assert rows(_ranked(_values(spark, n)).select(plain.columns)) == rows(plain)


def test_distributed_order_uses_several_partitions(spark):
    df = spark.range(5000).select("id", F.lit(1).alias("v"))  # every value ties
    by = ordering.Ordering([F.asc("v"), F.asc("id")], row_number="rn", dense_rank={"dense": "v"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ordering.rank_globally(df, by)
        assert [(r.rn, r.dense) for r in got.orderBy("id").collect()] == [(i + 1, 1) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("partitions", ["4", "400"])
def test_ranges_follow_the_bytes(spark, partitions):
    """Three megabytes of rows: the same ranges whatever the session's partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(100_000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("text"))
        asked = layout.ranges_for(stash(df, "test-rows"))
        assert 3 <= asked <= 5
        sizes = [r["count"] for r in sequence.sorted_ranges(df, "text", ["id"]).groupBy("_seq_part").count().collect()]
        assert len(sizes) == asked and max(sizes) < 2 * min(sizes)
        ranked = ordering.rank_globally(df, ordering.Ordering([F.asc("text")], row_number="rn"))
        assert ranked.filter("rn = 100000").count() == 1 and ranked.agg(F.count_distinct("rn")).first()[0] == 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_publishing_is_all_or_nothing(spark):
    path = scratch_path(spark, "test-published")
    with pytest.raises(FileNotFoundError):
        layout.published(spark, path)
    first = layout.publish(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("dies")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="dies"):
        layout.publish(broken, path)
    assert first.count() == layout.published(spark, path).count() == 5
    layout.publish(spark.range(9), path, ["id"])
    assert first.count() == 5 and layout.published(spark, path).count() == 9
    assert layout.retire(spark, path) == []
    layout.publish(spark.range(2), path)
    # The broken version goes with those before the newest two complete ones, if it left a folder.
    assert layout.retire(spark, path) in ([1], [1, 2]) and layout.published(spark, path).count() == 2


def test_ntile_of_seven(spark):
    df = spark.range(7)
    got = ordering.rank_globally(df, ordering.Ordering([F.asc("id")], ntile={"t": 5}))
    assert [r.t for r in got.orderBy("id").collect()] == [1, 1, 2, 2, 3, 4, 5]


def test_empty_input(spark):
    df = spark.range(0)
    assert ordering.rank_globally(df, ordering.Ordering([F.asc("id")], row_number="rn")).count() == 0


def _files_opened(path, column, value):
    """How many files a filter column = value cannot skip by their statistics, and how many there are."""
    import glob

    import pyarrow.parquet as pq

    opened, all_files = 0, glob.glob(f"{path}/**/*.parquet", recursive=True)
    for name in all_files:
        groups = pq.ParquetFile(name).metadata
        place = groups.schema.names.index(column)
        spans = [groups.row_group(g).column(place).statistics for g in range(groups.num_row_groups)]
        opened += any(not x.has_min_max or x.min <= value <= x.max for x in spans)
    return opened, len(all_files)


def test_interleaved_layout_skips_files_by_every_key(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"),
        F.concat(F.lit("s"), F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5_000)).cast("string"), 5, "0")).alias("b"),
        "id",
    )
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        layout.write_clustered(rows, f"{tmp_path}/both", ["a", "b"])
        layout.write_clustered(rows, f"{tmp_path}/one", ["a"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = spark.read.parquet(f"{tmp_path}/both")
    assert stored.exceptAll(rows).isEmpty() and stored.count() == 60_000
    assert _files_opened(f"{tmp_path}/one", "b", "s02500")[0] > 55
    for column, value in (("a", 5_000), ("b", "s02500"), ("a", 17), ("b", "s04990")):
        opened, files = _files_opened(f"{tmp_path}/both", column, value)
        assert files == 64 and opened <= 20, (column, value, opened, files)


def test_interleaved_layout_takes_nulls_few_values_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([(None, "x", 1), (2, None, 2), (2, "x", 3), (None, None, 4), (2, "x", 3)], "a int, b string, c int")
    for n, frame in enumerate((rows, rows.limit(0), rows.select(F.lit(None).cast("date").alias("a"), "b", "c"))):
        layout.write_clustered(frame, f"{tmp_path}/{n}", ["a", "b"])
        back = spark.read.schema(frame.schema).parquet(f"{tmp_path}/{n}")
        assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
    layout.write_clustered(rows, f"{tmp_path}/parts", ["a", "c"], partition_by=["b"])
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 5
