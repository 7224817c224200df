"""Position, count and next value of every row inside its key, whatever the size of the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from silverlode.operators.layout import ranges_for
from silverlode.session import stash

_PART, _POS = "_seq_part", "_seq_pos"
# monotonically_increasing_id() is the partition number shifted left by 33 bits plus the row index.
_ROW_BITS = 33


def number_in_key(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    number: str,
    count: str,
    next_value: tuple[str, str],
    heavy_rows: int = 1 << 20,
    ranges: int | None = None,
) -> DataFrame:
    """Adds ``number`` (1-based position), ``count`` (rows of the key) and the next row's value.

    ``next_value`` is ``(source column, output column)``. ``order`` ascends, nulls last, and should
    end in a unique column; a null key is a key of its own. Keys of up to ``heavy_rows`` rows take one
    exchange by key and a window. The rows are counted by key first, on the map side; what larger keys have
    is cut into sorted ranges of key and order (``ranges`` of them, or as their bytes ask for), so that a key of
    any size spreads over tasks.
    """
    sizes = df.groupBy(F.col(key).alias("_heavy_key")).agg(F.count(F.lit(1)).alias("_rows"))
    # Stored, so that its real size decides how the rows are joined to it.
    heavy = stash(sizes.filter(F.col("_rows") > heavy_rows).select("_heavy_key"), "heavy-keys")
    names = (number, count, next_value)
    if heavy.isEmpty():
        return _in_windows(df, key, order, *names)
    same = F.col(key).eqNullSafe(F.col("_heavy_key"))
    light = _in_windows(df.join(heavy, same, "left_anti"), key, order, *names)
    return light.unionByName(_in_ranges(df.join(heavy, same, "left_semi"), key, order, *names, ranges))


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def _in_windows(df: DataFrame, key: str, order: Sequence[str], number: str, count: str, next_value: tuple[str, str]) -> DataFrame:
    source, output = next_value
    along = W.partitionBy(key).orderBy(*_ascending(order))
    return df.select(
        *df.columns,
        F.row_number().over(along).alias(number),
        F.count(F.lit(1)).over(W.partitionBy(key)).alias(count),
        F.lead(source).over(along).alias(output),
    )


def _in_ranges(
    df: DataFrame, key: str, order: Sequence[str], number: str, count: str, next_value: tuple[str, str], ranges: int | None
) -> DataFrame:
    """The same over sorted ranges. Windows stay inside a range; what a key has in other ranges comes from
    a table of the first and last key of each range."""
    source, output = next_value
    rows = sorted_ranges(df, key, order, ranges)
    borders = _borders(rows, key, source)
    same = F.col(key).eqNullSafe(F.col("_border_key")) & (F.col(_PART) == F.col("_border_part"))
    in_range = W.partitionBy(_PART, key)
    local = rows.withColumns(
        {
            "_local": F.row_number().over(in_range.orderBy(_POS)),
            "_local_next": F.lead(F.struct(source)).over(in_range.orderBy(_POS)),
            "_local_count": F.count(F.lit(1)).over(in_range),
        }
    )
    joined = local.join(F.broadcast(borders), same, "left")
    return joined.select(
        *df.columns,
        (F.coalesce("_before", F.lit(0)) + F.col("_local")).cast("int").alias(number),
        F.coalesce("_all", "_local_count").alias(count),
        F.coalesce("_local_next", "_next_first")[source].alias(output),
    )


def sorted_ranges(df: DataFrame, key: str, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` stored in ranges of key and order, with the number of the range and the place in it."""
    by = _ascending([key, *order])
    held = stash(df, "sequence-input")
    placed = held.repartitionByRange(ranges or ranges_for(held), *by).sortWithinPartitions(*by)
    # Stored, because borders and rows must see the same ranges.
    placed = placed.withColumn(_POS, F.monotonically_increasing_id())
    return stash(placed, "sequence").withColumn(_PART, F.shiftright(_POS, _ROW_BITS))


def _borders(rows: DataFrame, key: str, source: str) -> DataFrame:
    """Of the first and last key of every range: rows before, rows in all, first value of the next range.

    Only such keys can go on in another range. Two rows per range at most, however many keys there are.
    """
    ends = rows.groupBy(_PART).agg(F.min_by(F.struct(key), _POS).alias("_low"), F.max_by(F.struct(key), _POS).alias("_high"))
    ends = ends.select(F.col(_PART).alias("_border_part"), F.explode(F.array_distinct(F.array("_low", "_high"))).alias("_end"))
    ends = ends.select("_border_part", F.col("_end")[key].alias("_border_key"))
    same = F.col(key).eqNullSafe(F.col("_border_key")) & (F.col(_PART) == F.col("_border_part"))
    pieces = rows.join(F.broadcast(ends), same).groupBy("_border_part", "_border_key").agg(
        F.count(F.lit(1)).alias("_rows"), F.min_by(F.struct(source), _POS).alias("_first")
    )
    along = W.partitionBy("_border_key").orderBy("_border_part")
    return pieces.select(
        "_border_part",
        "_border_key",
        F.coalesce(F.sum("_rows").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(W.partitionBy("_border_key")).alias("_all"),
        F.lead("_first").over(along).alias("_next_first"),
    )
