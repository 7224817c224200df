"""Row number, dense rank, n-tile and running sum over a whole table.

A window without ``partitionBy`` sends every row to one task. Here the rows are range-partitioned by
the order and sorted inside each partition; then position, rank and sum of a row are its value
inside the partition plus an offset, and there is one offset row per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverlode.operators.layout import ranges_for
from silverlode.session import stash

_PART, _POS = "_range_part", "_range_pos"
# monotonically_increasing_id() is the partition number shifted left by 33 bits plus the row index.
_ROW_BITS = 33


@dataclass(frozen=True)
class Ordering:
    """A total order (end it with a unique column) and the values to add under it.

    The mappings go from output name to source column (``ntile``: to the number of buckets). The
    source of ``dense_rank`` is the column that leads ``by``.
    """

    by: Sequence[Column]
    row_number: str | None = None
    ntile: Mapping[str, int] = field(default_factory=dict)
    dense_rank: Mapping[str, str] = field(default_factory=dict)
    running_sum: Mapping[str, str] = field(default_factory=dict)
    total: Mapping[str, str] = field(default_factory=dict)


def rank_globally(df: DataFrame, *orderings: Ordering) -> DataFrame:
    """``df`` with the columns of every ordering."""
    # Stored, because finding the range borders reads the rows once more.
    ranked = stash(df, "rank-input")
    ranges = ranges_for(ranked)
    for ordering in orderings:
        ranked = _in_ranges(ranked, ordering, ranges)
    return ranked


def ntile_of_rank(rank: Column, total: Column, buckets: int) -> Column:
    """Bucket of a 1-based rank when the first ``total % buckets`` buckets hold one row more."""
    small = F.floor(total / buckets).cast("bigint")
    big_buckets = total - small * buckets
    in_big = big_buckets * (small + 1)
    return (
        F.when(rank <= in_big, F.floor((rank - 1) / (small + 1)))
        .otherwise(big_buckets + F.floor(F.try_divide(rank - 1 - in_big, small)))
        .cast("int")
        + 1
    )


def _in_ranges(base: DataFrame, asked: Ordering, ranges: int) -> DataFrame:
    placed = (
        base.repartitionByRange(ranges, *asked.by)
        .sortWithinPartitions(*asked.by)
        .withColumn(_POS, F.monotonically_increasing_id())
    )
    # Stored, because the offsets and the rows must see the same range boundaries.
    rows = stash(placed, "rank-ranges").withColumn(_PART, F.shiftright(_POS, _ROW_BITS))

    in_part = W.partitionBy(_PART).orderBy(_POS)
    so_far = in_part.rowsBetween(W.unboundedPreceding, W.currentRow)
    local: dict[str, Column] = {}
    for name, source in asked.dense_rank.items():
        changed = ~F.col(source).eqNullSafe(F.lag(source).over(in_part))
        first = F.row_number().over(in_part) == 1
        local[f"_new_{name}"] = (first | changed).cast("bigint")
    if local:
        rows = rows.withColumns(local)
    sums = {name: F.sum(source).over(so_far) for name, source in asked.running_sum.items()}
    sums |= {name: F.sum(f"_new_{name}").over(so_far) for name in asked.dense_rank}
    if sums:
        rows = rows.withColumns(sums)

    joined = rows.join(F.broadcast(_offsets(rows, asked)), _PART)
    rank = F.col("_rows_before") + F.col(_POS).bitwiseAND((1 << _ROW_BITS) - 1) + 1
    added: dict[str, Column] = {}
    if asked.row_number:
        added[asked.row_number] = rank
    for name, buckets in asked.ntile.items():
        added[name] = ntile_of_rank(rank, F.col("_rows_total"), buckets)
    for name in asked.dense_rank:
        added[name] = F.col(name) + F.col(f"_before_{name}")
    for name in asked.running_sum:
        # A part whose values so far are all null has a null sum of its own, not a null total.
        both = [F.coalesce(F.col(c), F.lit(0)) for c in (name, f"_before_{name}")]
        known = F.coalesce(F.col(name), F.col(f"_before_{name}")).isNotNull()
        added[name] = F.when(known, both[0] + both[1])
    for name in asked.total:
        added[name] = F.col(f"_total_{name}")
    return joined.withColumns(added).select(*base.columns, *added)


def _offsets(rows: DataFrame, asked: Ordering) -> DataFrame:
    """One row per range partition: what all partitions before it hold. As small as the partition
    count, so the ordered window over it and its broadcast stay small whatever the input."""
    parts = rows.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(source).alias(f"_sum_{name}") for name, source in asked.running_sum.items()],
        *[F.sum(source).alias(f"_part_{name}") for name, source in asked.total.items()],
        *[
            piece
            for name, source in asked.dense_rank.items()
            for piece in (
                F.sum(f"_new_{name}").alias(f"_sum_{name}"),
                F.min_by(F.struct(source), _POS).alias(f"_first_{name}"),
                F.max_by(F.struct(source), _POS).alias(f"_last_{name}"),
            )
        ],
    )
    by_part = W.orderBy(_PART)
    before = by_part.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    for name in asked.dense_rank:
        # A value that goes on from the previous partition is not a new rank here.
        goes_on = F.col(f"_first_{name}") == F.lag(f"_last_{name}").over(by_part)
        parts = parts.withColumn(f"_goes_on_{name}", F.coalesce(goes_on, F.lit(False)).cast("bigint"))
    return parts.select(
        _PART,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(whole).alias("_rows_total"),
        *[F.sum(f"_sum_{name}").over(before).alias(f"_before_{name}") for name in asked.running_sum],
        *[F.sum(f"_part_{name}").over(whole).alias(f"_total_{name}") for name in asked.total],
        *[
            (
                F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0))
                - F.sum(f"_goes_on_{name}").over(
                    by_part.rowsBetween(W.unboundedPreceding, W.currentRow)
                )
            ).alias(f"_before_{name}")
            for name in asked.dense_rank
        ],
    )
