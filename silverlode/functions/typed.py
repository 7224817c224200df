"""Safe casts: what cannot be read becomes null, never an error.

Each helper mentions its column once. Casts trim by themselves and read blank text as null, so
wrapping them in ``blank_to_null`` would only evaluate the column twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.functions.text import ColumnLike, as_column

OPEN_END = dt.date(9999, 12, 31)
EARLIEST = dt.date(1900, 1, 1)


def to_int(c: ColumnLike) -> Column:
    """Whole numbers only: ``12.7`` is null, not 12 or 13."""
    return as_column(c).try_cast("int")


def to_money(c: ColumnLike, precision: int = 18, scale: int = 2) -> Column:
    return as_column(c).try_cast(f"decimal({precision},{scale})")


def iso_date(c: ColumnLike) -> Column:
    """``yyyy-MM-dd`` only; a cast would read a bare year as January 1st."""
    return F.try_to_date(F.trim(as_column(c)), "yyyy-MM-dd")


def compact_date(c: ColumnLike) -> Column:
    """``yyyyMMdd`` only; ``0``, ``5489`` or February 30th are null."""
    return F.try_to_date(F.trim(as_column(c)), "yyyyMMdd")


def open_end() -> Column:
    """The "still valid" date."""
    return F.lit(OPEN_END)
