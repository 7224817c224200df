"""Type 2 history from successive start dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions.calendar import days_between
from silverlode.functions.typed import open_end
from silverlode.operators.sequence import number_in_key

NEXT_START = "next_version_start_date"


def scd2(df: DataFrame, key: str, start: str, tiebreak: str) -> DataFrame:
    """Validity windows that tile each key's timeline.

    A version runs from its own start to the day before the next version's start, the last one to
    the open end. Adds ``valid_from_date``, ``valid_to_date``, ``is_current``, ``version_number``,
    ``version_count`` and ``valid_for_days``.
    """
    ordered = number_in_key(
        df,
        key,
        [start, tiebreak],
        number="version_number",
        count="version_count",
        next_value=(start, NEXT_START),
    )
    return (
        ordered.withColumns(
            {
                "valid_from_date": F.col(start),
                "valid_to_date": F.coalesce(F.date_sub(F.col(NEXT_START), 1), open_end()),
                "is_current": F.col(NEXT_START).isNull(),
            }
        )
        .withColumn("valid_for_days", days_between("valid_from_date", "valid_to_date"))
        .drop(NEXT_START)
    )
