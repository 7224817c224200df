"""One row per key out of a change feed, and one version per key out of a version history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_RANK = "_recency_rank"


def completeness(weights: Mapping[str, int]) -> Column:
    """Weighted count of the filled columns, e.g. ``{"first_name": 8, "last_name": 4}``."""
    score = F.lit(0)
    for name, weight in weights.items():
        score = score + F.when(F.col(name).isNotNull(), weight).otherwise(0)
    return score


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``; a hash of the row settles what still ties.

    Spark turns the filter on the row number into a group limit on both sides of the exchange: a
    task sends at most one row per key, so a key with a third of the rows costs the shuffle no more
    than any other key.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    window = W.partitionBy(*keys).orderBy(*order, row_hash.desc())
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def pick_version(
    df: DataFrame, key: str, order: Sequence[str], count_as: str | None = None
) -> DataFrame:
    """The row with the highest ``order`` values per key (nulls lowest), with the number of rows.

    An aggregate rather than a window, because the row count is needed in the same pass: both
    combine on the map side, so no task ever holds a whole key. Columns must be sortable.
    """
    others = [c for c in df.columns if c not in (key, *order)]
    best = F.max(F.struct(*order, *others)).alias("_best")
    counted = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    picked = df.groupBy(key).agg(best, *counted)
    columns = [F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns]
    return picked.select(*columns, *([count_as] if count_as else []))
