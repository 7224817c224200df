"""A Parquet table in versions, with upsert and window replacement.

Plain Spark has no MERGE on Parquet, and a job must not overwrite what it reads. So every commit
writes new folders only:

* ``data/load=<n>/<partition>=<value>/`` holds the rows that commit ``n`` wrote;
* ``versions/v=<n>/`` lists, for every partition value, the loads that now hold it.

A version counts once Spark's ``_SUCCESS`` marker is there, hence a failed commit is invisible and a
reader keeps the version it opened. A commit rewrites the partitions in which it replaces rows and no others:
where it only brings new rows, these lie beside the older loads, until a partition has ``_MOST_LOADS`` of them.

The listing also keeps, for each load, the schema of its files and every other schema that the table had since.
Loads with one such history are read together, as they were written, and taken from schema to schema up
to the newest: added columns are null in older rows, dropped ones are gone even if the name returns, and a
column may change its type as long as every stored value can be read as the new one. Which folders a commit
happened to rewrite makes no difference.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.session import CODEC
from silverlode.sources.files import child_folders, delete_folder, exists

_VERSION_SCHEMA = T.StructType(
    [T.StructField("load", T.LongType()), T.StructField("part", T.StringType()), T.StructField("schemas", T.StringType())]
)
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: A partition in so many loads is rewritten whole when it gets further rows.
_MOST_LOADS = 8


class DuplicateKeyError(ValueError):
    """The updates hold a key twice, so "replace the row" has no single meaning."""


class SchemaChangeError(ValueError):
    """A column changes to a type that some of its stored values cannot be read as."""


class VersionedTable:
    """``partition`` must be a string column with few values (a month, not a day and key).

    ``repeats``: several rows may have one key. An upsert then replaces all stored rows of a key by all its updates.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, partition: str, repeats: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.partition, self.repeats = key, partition, repeats

    # --- reading -------------------------------------------------------------------------------

    def version(self) -> int | None:
        """Newest complete version."""
        root = f"{self.path}/versions"
        numbers = [int(name.split("=")[1]) for name in child_folders(self.spark, root)]
        for number in sorted(numbers, reverse=True):
            if exists(self.spark, f"{root}/v={number}/_SUCCESS"):
                return number
        return None

    def _listing(self, version: int | None) -> list:
        """(load, part, schemas) of a version. A few entries per partition value, so small by construction."""
        if version is None:
            return []
        return self.spark.read.schema(_VERSION_SCHEMA).parquet(f"{self.path}/versions/v={version}").collect()

    def _loads(self, version: int | None) -> dict[str, tuple[int, ...]]:
        """Partition folder -> the loads that hold its rows, oldest first."""
        found: dict[str, tuple[int, ...]] = {}
        for row in sorted(self._listing(version), key=lambda row: row["load"]):
            found[row["part"]] = (*found.get(row["part"], ()), row["load"])
        return found

    def _holders(self, version: int | None) -> dict[str, int]:
        """Partition folder -> the newest load in it."""
        return {part: loads[-1] for part, loads in self._loads(version).items()}

    def _histories(self, version: int | None) -> dict[int, list[T.StructType]]:
        """Load -> schema of its files and those that the table had since, for the loads that a version holds."""
        texts = {row["load"]: row["schemas"] for row in self._listing(version)}
        found = {load: [T.StructType.fromJson(x) for x in json.loads(text)] for load, text in texts.items() if text}
        for load in texts.keys() - found.keys():
            # A listing from before schemas were kept: the files tell.
            shape = self.spark.read.parquet(f"{self.path}/data/load={load}").schema
            found[load] = [T.StructType([f for f in shape if f.name != self.partition])]
        if found and not all(texts.values()):
            newest = found[max(found)][-1]
            found = {load: shapes if shapes[-1] == newest else [*shapes, newest] for load, shapes in found.items()}
        return found

    def read(self, version: int | None = None) -> DataFrame | None:
        """The newest (or a given) version, None before the first commit, in the columns of its newest load."""
        version = self.version() if version is None else version
        return None if version is None else self._read_parts(self._loads(version), self._histories(version))

    def _read_parts(
        self, holders: Mapping[str, Sequence[int]], histories: dict[int, list[T.StructType]]
    ) -> DataFrame | None:
        """The rows that some loads have of some partitions: one read for each history of schemas."""
        alike: dict[str, list[str]] = {}
        for part, loads in sorted(holders.items()):
            for load in loads:
                alike.setdefault(_as_text(histories[load]), []).append(f"{self.path}/data/load={load}/{part}")
        place = T.StructField(self.partition, T.StringType())
        frames = []
        for text, folders in alike.items():
            first, *later = (T.StructType.fromJson(x) for x in json.loads(text))
            files = T.StructType([*first, T.StructField("load", T.LongType()), place])
            rows = self.spark.read.schema(files).option("basePath", f"{self.path}/data").parquet(*folders).drop("load")
            for shape in later:
                rows = in_shape(rows, T.StructType([*shape, place]))
            frames.append(rows)
        return reduce(DataFrame.unionByName, frames) if frames else None

    # --- writing -------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame, sort: Sequence[str] = (), placed: bool = False) -> int:
        """Full refresh: the new version holds exactly ``df``. ``placed``: the frame gathers the rows of a partition
        and sorts them itself, before it derives columns that need not travel."""
        number = self._next()
        self._write_rows(df, number, sort, placed)
        return self._publish(number, {part: (number,) for part in self._written(number)}, df.schema, {})

    def upsert(self, updates: DataFrame, sort: Sequence[str] = (), placed: bool = False) -> int:
        """Replace matched rows whole, insert the others, delete nothing.

        The updates are written once, as the new load. Rewritten are the partitions in which the target holds an
        updated key: a row whose date was restated leaves its old partition. Those that only get new rows keep
        their loads. ``placed`` as in ``overwrite``.
        """
        version = self.version()
        loads, histories = self._loads(version), self._histories(version)
        target = self._read_parts(loads, histories)
        self._check_casts(target, updates.schema)
        number = self._next()
        self._write_rows(updates, number, sort, placed)
        written = self._written(number)
        new = self._read_parts({part: (number,) for part in written}, {number: [self._files_schema(updates.schema)]})
        if new is not None and not self.repeats:
            repeated = new.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            if not repeated.isEmpty():
                delete_folder(self.spark, f"{self.path}/data/load={number}")
                raise DuplicateKeyError(f"updates hold a repeated {self.key}")
        rewritten: set[str] = set()
        if target is not None and new is not None:
            touched = {self._name(row[0]) for row in self._holding(target, new).distinct().collect()}
            # Spark escapes special characters in folder names.
            rewritten = {p for p in loads if unquote(p) in touched}
            rewritten |= {p for p in written if len(loads.get(p, ())) >= _MOST_LOADS}
        return self._commit(number, loads, histories, rewritten, updates.schema, sort, lambda old: old.join(
            new.select(self.key), self.key, "left_anti"
        ))

    def _holding(self, target: DataFrame, updates: DataFrame) -> DataFrame:
        """Partition values in which the target holds an updated key.

        Reads one column of the target. Keys outside the updates' key range cannot match, and as a
        literal range the test reaches the Parquet statistics: row groups without recent keys are
        not read.
        """
        low, high = updates.agg(F.min(self.key), F.max(self.key)).first()
        near = target.filter(F.col(self.key).between(low, high)) if low is not None else target.limit(0)
        near, keys, by = near.select(self.key, self.partition), updates.select(self.key), self.key
        if {near.schema[by].dataType, keys.schema[by].dataType} == {T.StringType()}:
            # Texts are compared by hash, which may only name a partition too many.
            near, keys = (x.withColumn("_hash", F.xxhash64(by)).drop(by) for x in (near, keys))
            by = "_hash"
        return near.join(keys, by, "left_semi").select(self.partition)

    def replace_window(
        self, rows: DataFrame, in_window: Column, window_parts: Column, sort: Sequence[str] = (), placed: bool = False
    ) -> int:
        """Delete-aware alternative to ``upsert``: the rows ``in_window`` become exactly ``rows``.

        ``window_parts`` is the implied condition on the partition column; it picks the partitions
        to rewrite. The rows are written once; of the rewritten partitions the rows outside the window join them.
        ``placed`` as in ``overwrite``.
        """
        version = self.version()
        loads, histories = self._loads(version), self._histories(version)
        target = self._read_parts(loads, histories)
        if target is None:
            return self.overwrite(rows, sort, placed)
        self._check_casts(target, rows.schema)
        number = self._next()
        self._write_rows(rows, number, sort, placed)
        parts = target.select(self.partition).filter(window_parts).distinct()
        touched = {self._name(row[0]) for row in parts.collect()}
        # Spark escapes special characters in folder names.
        rewritten = {p for p in loads if unquote(p) in touched} | (set(self._written(number)) & set(loads))
        return self._commit(number, loads, histories, rewritten, rows.schema, sort, lambda old: old.filter(
            ~F.coalesce(in_window, F.lit(False))
        ))

    def changed(self, before: int) -> DataFrame:
        """Rows of the newest version that version ``before`` has not, repeated rows counted.

        The partition value is part of a row, so a partition that the same loads hold in both versions has none.
        """
        now = self.version()
        new, old = self._loads(now), self._loads(before)
        rows = self.read(now)
        # Loads that both versions have of a partition are the same files.
        moved = {p: [n for n in loads if n not in old.get(p, ())] for p, loads in new.items()}
        moved = {p: loads for p, loads in moved.items() if loads}
        known = self._read_parts(
            {p: [n for n in old[p] if n not in new[p]] for p in moved if p in old}, self._histories(before)
        )
        if not moved:
            return rows.limit(0)
        rewritten = in_shape(self._read_parts(moved, self._histories(now)), rows.schema)
        return rewritten if known is None else rewritten.exceptAll(in_shape(known, rows.schema))

    def partitions(self) -> list[str]:
        """Partition values of the newest version."""
        return sorted(unquote(part.split("=", 1)[1]) for part in self._loads(self.version()))

    def replace_partitions(
        self, rows: DataFrame | None, gone: Sequence[str] = (), sort: Sequence[str] = (), placed: bool = False
    ) -> int:
        """The partitions that ``rows`` have become exactly those rows, ``gone`` ones are dropped, others stay."""
        version, number = self.version(), self._next()
        dropped = {self._name(value) for value in gone}
        loads = {p: n for p, n in self._loads(version).items() if unquote(p) not in dropped}
        histories = self._histories(version)
        if rows is None:
            schema = histories[max(histories)][-1]
        else:
            schema = rows.schema
            self._check_casts(self._read_parts(loads, histories), schema)
            self._write_rows(rows, number, sort, placed)
            loads |= {p: (number,) for p in self._written(number)}
        return self._publish(number, loads, schema, histories)

    def _commit(
        self,
        number: int,
        loads: dict[str, tuple[int, ...]],
        histories: dict[int, list[T.StructType]],
        rewritten: set[str],
        schema: T.StructType,
        sort: Sequence[str],
        keep: Callable[[DataFrame], DataFrame],
    ) -> int:
        """Publish load ``number``, written already, with what ``keep`` leaves of the rewritten partitions added to it."""
        old = self._read_parts({p: n for p, n in loads.items() if p in rewritten}, histories)
        if old is not None:
            self._write_rows(keep(in_shape(old, schema)), number, sort, mode="append")
        held = {p: n for p, n in loads.items() if p not in rewritten}
        held |= {p: (*held.get(p, ()), number) for p in self._written(number)}
        return self._publish(number, held, schema, histories)

    def _check_casts(self, stored: DataFrame | None, new: T.StructType) -> None:
        """Refuse a change of type that would lose stored values, before anything is written.

        Reads only columns that change to a type which cannot hold every value of the old one. Text must be
        readable as the new type; other values must come back when cast back.
        """
        wanted = {f.name: f.dataType for f in new}
        have = {f.name: f.dataType for f in stored.schema} if stored is not None else {}
        risky = [c for c, kind in have.items() if c in wanted and not _widens(kind, wanted[c])]
        if not risky:
            return

        def lost(name: str) -> Column:
            cast = F.col(name).try_cast(wanted[name])
            text = isinstance(have[name], T.StringType)
            return F.col(name).isNotNull() & (cast.isNull() if text else ~cast.try_cast(have[name]).eqNullSafe(F.col(name)))

        for name, n in stored.agg(*[F.count_if(lost(c)).alias(c) for c in risky]).first().asDict().items():
            if n:
                kinds = f"{have[name].simpleString()} to {wanted[name].simpleString()}"
                raise SchemaChangeError(f"{n} stored values of {name} do not survive the change from {kinds}")

    def _name(self, value: str | None) -> str:
        return f"{self.partition}={_NULL_FOLDER if value is None else value}"

    def _next(self) -> int:
        """Above every number ever used, so that leftovers of a failed commit are never mixed in."""
        used = child_folders(self.spark, f"{self.path}/data")
        used += child_folders(self.spark, f"{self.path}/versions")
        return 1 + max([int(name.split("=")[1]) for name in used], default=0)

    def _write_rows(
        self, df: DataFrame, number: int, sort: Sequence[str], placed: bool = False, mode: str = "errorifexists"
    ) -> None:
        # REBALANCE groups a partition's rows into few files and splits a big month over many tasks.
        rows = df if placed else df.hint("rebalance", self.partition)
        if sort and not placed:
            rows = rows.sortWithinPartitions(self.partition, *sort)
        writer = rows.write.mode(mode).option("compression", CODEC).partitionBy(self.partition)
        writer.parquet(f"{self.path}/data/load={number}")

    def _written(self, number: int) -> list[str]:
        return child_folders(self.spark, f"{self.path}/data/load={number}")

    def _publish(
        self,
        number: int,
        loads: Mapping[str, Sequence[int]],
        schema: T.StructType,
        histories: dict[int, list[T.StructType]],
    ) -> int:
        newest = self._files_schema(schema)
        histories = {load: known if known[-1] == newest else [*known, newest] for load, known in histories.items()}
        histories[number] = [newest]
        rows = [(load, part, _as_text(histories[load])) for part in sorted(loads) for load in loads[part]]
        listing = self.spark.createDataFrame(rows, _VERSION_SCHEMA).coalesce(1)
        listing.write.parquet(f"{self.path}/versions/v={number}")
        return number

    def _files_schema(self, schema: T.StructType) -> T.StructType:
        """A frame's schema as its files have it."""
        written = T.StructType([f for f in schema if f.name != self.partition])
        return T.StructType.fromJson(_nullable(json.loads(written.json())))


def _as_text(schemas: Sequence[T.StructType]) -> str:
    return json.dumps([json.loads(s.json()) for s in schemas])


def _nullable(schema):
    """A schema as files have it: everything may be null."""
    if isinstance(schema, list):
        return [_nullable(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    free = {"nullable", "containsNull", "valueContainsNull"}
    return {k: True if k in free else v if k == "metadata" else _nullable(v) for k, v in schema.items()}


#: Whole numbers by size.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` can be read as ``new``."""
    if old == new or (isinstance(new, T.StringType) and isinstance(old, T.AtomicType)):
        return True
    if type(old) in _WHOLE and type(new) in _WHOLE:
        return _WHOLE.index(type(old)) <= _WHOLE.index(type(new))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def in_shape(rows: DataFrame, shape: T.StructType) -> DataFrame:
    """``rows`` in the columns of ``shape``: missing ones null, others of another type cast, further ones dropped."""
    have = {f.name: f.dataType for f in rows.schema}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType)
        given = F.col(field.name)
        return given if have[field.name] == field.dataType else given.try_cast(field.dataType)

    return rows.select(*[column(f).alias(f.name) for f in shape])


def lookback(source: DataFrame, target: DataFrame | None, date: str, days: int) -> DataFrame:
    """Source rows from ``days`` before the target's newest date on (all rows for an empty target)."""
    if target is None:
        return source
    newest = target.agg(F.coalesce(F.max(date), F.lit("1900-01-01").cast("date"))).scalar()
    return source.filter(F.col(date) >= F.date_sub(newest, days))


def stale_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source no longer has: an upsert never removes them."""
    return target.join(source.select(key), key, "left_anti")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column only some frames have is null in the others."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
