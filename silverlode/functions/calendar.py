"""Date arithmetic and the calendar attributes shared by the date dimension and the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.functions.text import ColumnLike, as_column

# Short month names and day names, Sunday first.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Upper bound in completed years (inclusive) and label of every age band but the last.
AGE_BANDS = ((17, "Under 18"), (24, "18-24"), (34, "25-34"), (44, "35-44"), (54, "45-54"), (64, "55-64"))
OLDEST_BAND = "65+"
UNKNOWN = "Unknown"


def _nth(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    return F.datediff(as_column(end), as_column(start))


def as_of_date(as_of: dt.date | None) -> Column:
    """The run's date, or the current date where none is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def full_years(start: ColumnLike, end: ColumnLike) -> Column:
    """Completed years. A February 29th birthday completes on March 1st of a common year, which
    ``months_between`` gets wrong, so months and days are compared as one number."""
    start, end = as_column(start), as_column(end)
    not_reached = F.month(end) * 100 + F.dayofmonth(end) < F.month(start) * 100 + F.dayofmonth(start)
    return F.year(end) - F.year(start) - not_reached.cast("int")


def age_band(birth_date: ColumnLike, age: ColumnLike) -> Column:
    age = as_column(age)
    banded = F.when(as_column(birth_date).isNull() | age.isNull(), UNKNOWN)
    for upper, label in AGE_BANDS:
        banded = banded.when(age <= upper, label)
    return banded.otherwise(OLDEST_BAND)


def calendar_attributes(c: ColumnLike, prefix: str) -> dict[str, Column]:
    """Calendar columns of a date, named ``<prefix>_year``, ``<prefix>_quarter`` and so on."""
    day = as_column(c).cast("date")
    parts = {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month_number": F.month(day),
        "month_name": _nth(MONTH_NAMES, F.month(day)),
        "month_start": F.trunc(day, "month"),
        "day_of_year": F.dayofyear(day),
        "day_of_week": F.dayofweek(day),  # 1 = Sunday
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_name": _nth(DAY_NAMES, F.dayofweek(day)),
        "year_quarter": F.concat_ws("-Q", F.year(day).cast("string"), F.quarter(day).cast("string")),
        "year_month": year_month(day),
    }
    return {f"{prefix}_{name}": column for name, column in parts.items()}


def month_count(c: ColumnLike) -> Column:
    """The month of a date as a number that counts on over the years; shorter than ``year_month`` to shuffle by."""
    return F.year(as_column(c)) * 12 + F.month(as_column(c))


def year_month(c: ColumnLike) -> Column:
    """``yyyy-MM`` text of a date; sorts like the date and names a month folder."""
    return F.substring(as_column(c).cast("string"), 1, 7)
