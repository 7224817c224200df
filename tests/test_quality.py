import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import quality as q
from silverlode.session import scratch_path


def counts(df):
    return {r.check_name: r.failures for r in df.collect()}


def test_row_checks_share_one_scan(spark):
    df = spark.createDataFrame([(1, "M"), (None, "X"), (3, None)], "a int, g string")
    checks = [*q.not_null("a", "g"), q.accepted("g", ("M", "F")), q.expression("small", "a < 3")]
    counted = q.count_row_checks(df, checks)
    assert counts(counted) == {"not_null_a": 1, "not_null_g": 1, "accepted_g": 1, "expression_small": 2}
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1


def test_unique_ignores_nulls_and_combination_counts_them(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "a int")
    assert counts(q.count_violations(df, [*q.unique("a")])) == {"unique_a": 1}
    assert counts(q.count_violations(df, [q.unique_combination("a")])) == {"unique_a": 2}


def test_run_checks_reports_stores_and_stops(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    store = scratch_path(spark, "checks")
    warned = q.run_checks({"t": (df, [*q.not_null("a", severity="warn"), q.expression("pos", "a is null or a > 0")])}, store)
    assert {(r["check_name"], r["status"]) for r in warned} == {("not_null_a", "warn"), ("expression_pos", "pass")}
    assert spark.read.parquet(f"{store}/t__not_null_a").count() == 1
    with pytest.raises(q.QualityError, match="t.unique_a: 1"):
        q.run_checks({"t": (df, q.unique("a"))}, store)
    assert spark.read.parquet(f"{store}/t__unique_a").collect()[0].row_count == 2
    assert q.run_checks({"t": (df, q.unique("a"))}, stop_on_error=False)[0]["status"] == "error"
    q.run_checks({"t": (df.dropDuplicates(["a"]), q.unique("a"))}, store)
    assert spark.read.parquet(f"{store}/t__unique_a").count() == 0


@pytest.mark.parametrize("hours,status", [(23, "pass"), (24, "pass"), (25, "warn"), (72, "warn"), (73, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2026, 1, 10)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (dt.datetime(2020, 1, 1),)], "at timestamp")
    got = q.freshness(df, "at", now, 24, 72).first()
    assert (got.status, got.age_hours) == (status, hours)


def test_freshness_of_nothing(spark):
    df = spark.createDataFrame([], "at timestamp")
    assert q.freshness(df, "at", dt.datetime(2026, 1, 1), 24, 72).first().status == "error"


@pytest.mark.parametrize("rejects,over", [(9, False), (10, False), (11, True)])
def test_rejection_rate(spark, rejects, over):
    source, kept = spark.range(1000), spark.range(1000 - rejects)
    got = q.rejection_rate(source, kept, 0.01).first()
    assert (got.rejected_row_count, got.exceeds_cap) == (rejects, over)


def test_rejection_rate_of_nothing(spark):
    got = q.rejection_rate(spark.range(0), spark.range(0), 0.01).first()
    assert (got.source_row_count, got.rejection_rate, got.exceeds_cap) == (0, None, False)


def test_reconcile(spark):
    source = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 2)], "k string, amount double, units int")
    source = source.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    assert q.reconcile_breaks(q.reconcile(source, source, "k", "amount", "units")).isEmpty()
    fanned = source.union(source.filter("k = 'a'"))
    row = q.reconcile_breaks(q.reconcile(fanned, source, "k", "amount", "units")).first()
    assert (row.fact_row_count, row.expected_row_count, row.distinct_line_count) == (3, 2, 2)


def test_version_breaks(spark):
    d = dt.date
    df = spark.createDataFrame(
        [
            ("p", d(2011, 1, 1), d(2011, 12, 31), False), ("p", d(2012, 1, 1), d(9999, 12, 31), True),
            ("q", d(2011, 1, 1), d(2012, 6, 1), False), ("q", d(2012, 1, 1), d(9999, 12, 31), False),
            ("r", d(2012, 1, 1), d(2011, 1, 1), True),
        ],
        "k string, valid_from_date date, valid_to_date date, is_current boolean",
    )
    got = {r.failure_reason: r.offending_rows for r in q.version_breaks(df, "k").collect()}
    assert got == {"missing_current_version": 1, "overlapping_version_window": 1, "inverted_version_window": 1}


def test_referential_breaks(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", None, "y"), ("b", "x", "y")], "k string, c string, p string")
    got = {r.failure_reason: r.offending_rows for r in q.referential_breaks(df, "k", {"no_c": "c", "no_p": "p"}).collect()}
    assert got == {"no_c": 1, "no_p": 1, "duplicate_line_key": 1}


def test_unmapped_codes(spark):
    df = spark.createDataFrame([("ZZ",), ("ZZ",), ("us",), ("Unknown",), ("Germany",), (None,)], "country string")
    assert [tuple(r) for r in q.unmapped_codes(df, "country").collect()] == [("ZZ", 2)]


def test_orphans_are_null_safe(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in q.orphan_keys(child, parent, "k").collect()] == [2]
