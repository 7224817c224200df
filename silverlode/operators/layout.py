"""Layer sinks, clustered writes and compaction."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.session import stash
from silverlode.sources.files import child_folders, delete_folder, exists


#: Ranges per key of an interleaved order: two to this power.
_RANK_BITS = 6
#: Rows that the borders of the ranges are taken from. They only shape files, never results.
_BORDER_ROWS = 20_000


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """Store ``df`` in files whose Parquet min/max statistics let a filter on any of ``keys`` skip most of them.

    One key: sorted by it in non-overlapping ranges. Several: sorted by the interleaved bits of the keys' range
    numbers (``interleaved``), so that a file covers a short stretch of each key instead of all values of the second.
    A row hash ends the order of the ranges: rows of one hot key value spread over files.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    if len(keys) > 1:
        # Read for the borders, for the ranges and for the rows.
        df = stash(df, "clustered")
        place = interleaved(df, keys)
        placed = df.repartitionByRange(*partition_by, place, spread).sortWithinPartitions(*partition_by, place, *keys)
    else:
        columns = [*partition_by, *keys]
        placed = df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns)
    placed.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def interleaved(df: DataFrame, keys: Sequence[str]) -> Column:
    """The place of a row in a Z-shaped order over ``keys``, of any types that can be sorted.

    Each key's values are cut into up to 64 ranges of about equal row numbers; the bits of the range numbers take
    turns, the highest first. Nulls come first. A key with few values has fewer ranges, which leaves
    its high bits to the others. The borders come from 20,000 random rows, 63 values per key.
    """
    ranges = 1 << _RANK_BITS
    picked = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).orderBy(F.rand(11)).limit(_BORDER_ROWS)
    found = picked.agg(*[F.array_sort(F.collect_list(f"k{i}")).alias(f"k{i}") for i in range(len(keys))])
    steps = F.sequence(F.lit(1), F.lit(ranges - 1))

    def borders(values: Column) -> Column:
        at = F.transform(steps, lambda s: F.floor(s * F.size(values) / ranges).cast("int"))
        return F.array_distinct(F.transform(F.filter(at, lambda x: x < F.size(values)), lambda x: F.get(values, x)))

    row = found.select(*[borders(F.col(f"k{i}")).alias(f"k{i}") for i in range(len(keys))]).first()
    place = F.lit(0).cast("bigint")
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        rank = _range_number(F.col(key), [F.lit(value).cast(kind) for value in row[i]])
        for bit in range(_RANK_BITS):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(keys) + len(keys) - 1 - i))
    return place


def _range_number(key: Column, borders: Sequence[Column]) -> Column:
    """How many of the sorted ``borders`` are not above ``key``, as the highest numbers of 64; by halving."""
    if not borders:
        return F.lit(0).cast("bigint")
    # Few borders count in wide steps, so that their ranges differ in high bits.
    width = (1 << _RANK_BITS) // (len(borders) + 1)

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low * width).cast("bigint")
        middle = (low + high) // 2
        return F.when(key >= borders[middle], halve(middle + 1, high)).otherwise(halve(low, middle))

    return halve(0, len(borders))


def materialise(
    df: DataFrame, layer: str, name: str, root: str, cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Silver stays lazy (a temporary view); gold is published and read back."""
    if layer == "silver":
        df.createOrReplaceTempView(name)
        return df
    return publish(df, f"{root.rstrip('/')}/{layer}/{name}", cluster_by)


def publish(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Store ``df`` as the next version of the table at ``path`` and read it back.

    Every version is a folder of its own, and Spark's success marker in it is the switch: until the last task is
    done readers get the version before, whose files stay. A job that dies leaves a folder without marker.
    """
    spark = df.sparkSession
    folder = f"{path}/v={1 + max(_versions(spark, path), default=0)}"
    if cluster_by:
        write_clustered(df, folder, cluster_by)
    else:
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of the table at ``path``."""
    complete = [v for v in _versions(spark, path) if exists(spark, f"{path}/v={v}/_SUCCESS")]
    if not complete:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/v={max(complete)}")


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete the versions before the newest ``keep`` complete ones, which readers may still hold. Returns them."""
    versions = _versions(spark, path)
    complete = [v for v in versions if exists(spark, f"{path}/v={v}/_SUCCESS")]
    old = [v for v in versions if len(complete) >= max(1, keep) and v < complete[-max(1, keep)]]
    for version in old:
        delete_folder(spark, f"{path}/v={version}")
    return old


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name[2:]) for name in child_folders(spark, path) if name.startswith("v="))


def ranges_for(stored: DataFrame, target_mb: int = 256) -> int:
    """Into how many ranges to sort a stored frame: by the bytes of its files, whatever the session's partitions.

    Ranges of about ``target_mb``; tables of up to 64 MB get one for each megabyte, so that small ones use many cores.
    """
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    mega = 1 << 20
    return max(1, min(64, math.ceil(size / mega)), math.ceil(size / (target_mb * mega)))


def file_sizes(spark: SparkSession, path: str, suffix: str = "parquet") -> DataFrame:
    """One row (path, length) per data file; the content column is never read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}")
    return listing.option("recursiveFileLookup", "true").load(path).select("path", "length")


def compact(
    spark: SparkSession, source: str, target: str, target_mb: int = 256, rows: DataFrame | None = None
) -> DataFrame:
    """Copy a table of many small files into few files of about ``target_mb`` in a new folder.

    Same rows; the source stays as it was, because readers may hold it and because a streaming
    sink's folder lists its own files. The caller switches to the new folder. ``rows`` is the
    source already read, where its schema needs care.
    """
    total = file_sizes(spark, source).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    files = max(1, math.ceil(total / (target_mb * 1024 * 1024)))
    if rows is None:
        rows = spark.read.option("mergeSchema", "true").parquet(source)
    # No exchange: a task reads several neighbouring small files and writes one.
    rows.coalesce(files).write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target)
