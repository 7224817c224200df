import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlode.functions import calendar, labels, measures, text, typed

D = dt.date


def apply(spark, values, schema, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {schema}")
    return [r[0] for r in df.orderBy("i").select(column.alias("y")).collect()]


def test_safe_casts(spark):
    assert apply(spark, [" 12 ", "12.7", "abc", "", None, "-3"], "string", typed.to_int("x")) == [12, None, None, None, None, -3]
    assert apply(spark, ["12.345", " 7 ", "x", ""], "string", typed.to_money("x")) == [Decimal("12.35"), Decimal("7.00"), None, None]
    assert apply(spark, ["2011-07-01", " 2011-07-01", "2011", "not a date", "2011-7-1", ""], "string", typed.iso_date("x")) == [
        D(2011, 7, 1), D(2011, 7, 1), None, None, None, None]
    bad = ["0", "5489", "20100230", "201012290", "", None, "2010-1-1"]
    assert apply(spark, ["20101229", " 20101229 ", *bad], "string", typed.compact_date("x")) == [D(2010, 12, 29)] * 2 + [None] * len(bad)


def test_text(spark):
    assert apply(spark, ["  a b ", "   ", None], "string", text.blank_to_null("x")) == ["a b", None, None]
    assert apply(spark, [" r ", ""], "string", text.upper_code("x")) == ["R", None]
    names = ["HL Road Frame - Black- 58", "Sport-100 Helmet- Red", "bass  class", " - "]
    assert apply(spark, names, "string", text.clean_name("x")) == ["HL Road Frame Black 58", "Sport 100 Helmet Red", "bass class", None]
    keys = ["NASAW00011000", "AWNAS1", "nasAW1", None]
    assert apply(spark, keys, "string", text.drop_prefix("x", "NAS")) == ["AW00011000", "AWNAS1", "nasAW1", None]
    assert apply(spark, ["AW-00011000", "A-B-C"], "string", text.drop_dashes("x")) == ["AW00011000", "ABC"]
    parts = text.split_qualified_key("x")
    assert apply(spark, ["BI-RB-BK-R64Y-48"], "string", F.struct(*[c.alias(n) for n, c in parts.items()])) == [("BI-RB", "BI_RB", "BK-R64Y-48")]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, None)], "a string, b string")
    got = df.select(text.full_name("a", "b"), text.hashed_key("cust", "a"), text.dashed_key("a", "b")).collect()
    assert [r[0] for r in got] == ["A B", "A", ""]
    assert got[2][1] is None
    assert [r[2] for r in got] == ["A-B", None, None]


def test_hashed_key_is_md5_of_prefixed_text(spark):
    import hashlib

    got = apply(spark, ["AW1"], "string", text.hashed_key("cust", "x"))
    assert got == [hashlib.md5(b"cust|AW1").hexdigest()]


def test_full_years(spark):
    pairs = [
        (D(2000, 2, 29), D(2001, 2, 28), 0),
        (D(2000, 2, 29), D(2001, 3, 1), 1),
        (D(1990, 6, 15), D(2020, 6, 14), 29),
        (D(1990, 6, 15), D(2020, 6, 15), 30),
        (None, D(2020, 1, 1), None),
        (D(2020, 1, 1), None, None),
    ]
    df = spark.createDataFrame([(i, *p[:2]) for i, p in enumerate(pairs)], "i int, a date, b date").orderBy("i")
    assert [r[0] for r in df.select(calendar.full_years("a", "b")).collect()] == [p[2] for p in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.dates(D(1900, 1, 1), D(2100, 1, 1)), st.dates(D(1900, 1, 1), D(2100, 1, 1))), min_size=1, max_size=40))
def test_full_years_property(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a date, b date").orderBy("i")
    got = [r[0] for r in df.select(calendar.full_years("a", "b")).collect()]
    assert got == [b.year - a.year - ((b.month, b.day) < (a.month, a.day)) for a, b in pairs]


def test_age_bands(spark):
    ages = [-1, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, 120, None]
    got = apply(spark, ages, "int", calendar.age_band(F.lit(D(2000, 1, 1)), "x"))
    assert got == ["Under 18", "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64", "65+", "65+", "Unknown"]
    assert apply(spark, [30], "int", calendar.age_band(F.lit(None).cast("date"), "x")) == ["Unknown"]


def test_calendar_attributes(spark):
    attributes = calendar.calendar_attributes("x", "d")
    one = F.struct(*[c.alias(n) for n, c in attributes.items()])
    sunday, new_year = apply(spark, [D(2024, 1, 7), D(2010, 1, 1)], "date", one)
    assert (sunday.d_day_of_week, sunday.d_day_name, sunday.d_year_quarter, sunday.d_year_month) == (1, "Sunday", "2024-Q1", "2024-01")
    assert (sunday.d_month_name, sunday.d_month_start, sunday.d_day_of_year) == ("Jan", D(2024, 1, 1), 7)
    assert (new_year.d_week_of_year, new_year.d_day_of_week, new_year.d_day_name) == (53, 6, "Friday")


def test_ratio(spark):
    df = spark.createDataFrame([(Decimal("100.01"), 2), (Decimal("-100.01"), 2), (Decimal("1"), 0), (Decimal("1"), None), (Decimal("1"), 3)], "n decimal(18,2), d int")
    got = [r[0] for r in df.select(measures.ratio("n", "d", 2)).collect()]
    assert got == [Decimal("50.01"), Decimal("-50.01"), None, None, Decimal("0.33")]
    close = spark.createDataFrame(
        [(Decimal("1234499999999.99"), Decimal("10000000000000.00")), (Decimal("-9999999999999999.99"), Decimal("0.01")), (Decimal("0.00"), Decimal("-3"))],
        "n decimal(18,2), d decimal(18,2)",
    )
    got = [r[0] for r in close.select(measures.ratio("n", "d", 4)).collect()]
    assert got == [Decimal("0.1234"), Decimal("-999999999999999999"), Decimal("0")]


MONEY = st.one_of(
    st.integers(-(10**18) + 1, 10**18 - 1), st.integers(-5000, 5000), st.sampled_from([10**17 - 1, 10**17, 1 - 10**17, 10**15, 10**17 + 5])
).map(lambda cents: Decimal(cents).scaleb(-2))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(MONEY, MONEY), min_size=1, max_size=60))
def test_ratio_is_exact_at_every_size(spark, pairs):
    from fractions import Fraction
    from math import floor

    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n decimal(18,2), d decimal(18,2)").orderBy("i")
    for scale in (2, 4):
        got = [r[0] for r in df.select(measures.ratio("n", "d", scale)).collect()]
        for (n, d), value in zip(pairs, got, strict=True):
            if not d:
                assert value is None
                continue
            exact = abs(Fraction(n) / Fraction(d)) * 10**scale
            rounded = floor(exact + Fraction(1, 2))
            assert value == Decimal(-rounded if (n < 0) != (d < 0) else rounded).scaleb(-scale)


def test_ratio_near_ties(spark):
    """Quotients next to a half of the last place, with divisors of up to 17 digits."""
    rows = [(Decimal(2 * k * b + e).scaleb(-2) / 2, Decimal(b).scaleb(-2)) for b in (10**16 + 7, 3, 99999999999999999) for k in (0, 1) for e in (b - 1, b, b + 1) if (2 * k * b + e) % 2 == 0]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "i int, n decimal(18,2), d decimal(18,2)").orderBy("i")
    got = [r[0] for r in df.select(measures.ratio("n", "d", 0)).collect()]
    from fractions import Fraction
    from math import floor

    assert got == [floor(Fraction(n) / Fraction(d) + Fraction(1, 2)) for n, d in rows]


def test_margins(spark):
    df = spark.createDataFrame(
        [(Decimal("100"), 2, Decimal("50"), Decimal("30")), (Decimal("100"), 2, Decimal("50"), Decimal("0")), (Decimal("100"), 2, Decimal("50"), None)],
        "a decimal(18,2), q int, p decimal(18,2), c decimal(12,2)",
    )
    got = df.select(*[c.alias(n) for n, c in measures.margin_measures("a", "q", "p", "c").items()]).collect()
    assert [tuple(r) for r in got] == [(Decimal("40.00"), Decimal("0.4000"), 0.4), (Decimal("100.00"), None, 1.0), (None, None, None)]


def test_labels(spark):
    assert apply(spark, ["M", "SINGLE", "X", None], "string", labels.marital_status("x")) == ["Married", "Single", "Unknown", "Unknown"]
    assert apply(spark, ["F", "MALE", "?", None], "string", labels.gender("x")) == ["Female", "Male", "Unknown", "Unknown"]
    assert apply(spark, ["R", "Q", None], "string", labels.product_line("x")) == ["Road", "Other", "Other"]
    assert apply(spark, ["us", "DE", "Australia", "ZZ", None], "string", labels.country("x")) == ["United States", "Germany", "Australia", "ZZ", "Unknown"]
    assert apply(spark, ["ZZ"], "string", labels.country("x", {"ZZ": "Zedland"})) == ["Zedland"]
    assert apply(spark, ["YES", "Y", "NO", "?", None], "string", labels.maintenance_flag("x")) == [True, True, False, False, False]


@pytest.mark.parametrize("first,second,want", [("Unknown", "Male", "Male"), ("Female", "Male", "Female"), ("Unknown", None, "Unknown"), (None, None, "Unknown")])
def test_preferred_gender(spark, first, second, want):
    df = spark.createDataFrame([(first, second)], "a string, b string")
    assert df.select(labels.preferred_gender("a", "b")).first()[0] == want


def test_segments_and_bands(spark):
    from silverlode.plans.marts import _segment

    cases = {(4, 4, 4): "Champions", (3, 4, 1): "Loyal Customers", (4, 2, 5): "Recent Customers", (2, 3, 5): "At Risk",
             (1, 1, 5): "Hibernating", (3, 3, 5): "Big Spenders", (3, 3, 1): "Need Attention"}
    df = spark.createDataFrame(list(cases), "recency_score int, frequency_score int, monetary_score int")
    assert [r[0] for r in df.select(_segment()).collect()] == list(cases.values())
