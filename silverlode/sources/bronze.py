"""Batch load of raw extracts into bronze: strings plus lineage, append or overwrite."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.layout import file_sizes
from silverlode.operators.versioned import union_all
from silverlode.session import CODEC
from silverlode.sources.files import child_folders, exists
from silverlode.sources.headers import FileHeader, list_files, read_headers
from silverlode.sources.specs import RESCUED, SourceSpec, sources, string_schema

BATCH = "_batch_id"


class EmptyLoadError(RuntimeError):
    """A table received no rows."""


@dataclass(frozen=True)
class Load:
    """Outcome of loading one extract; ``problem`` tells why nothing of it could be loaded."""

    table: str
    system: str
    batch_id: str
    row_count: int
    rescued_row_count: int
    file_count: int
    mode: str
    problem: str | None = None


# --- reading ---------------------------------------------------------------------------------------


def read_raw(
    spark: SparkSession, spec: SourceSpec, headers: Sequence[FileHeader], keep_extra: bool = True
) -> DataFrame:
    """All files as strings, selected by name, with ``_rescued_data`` and ``_source_file``.

    One read per distinct header, not per file. A row with too few or too many fields is kept: its
    whole text lands in ``_rescued_data``.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for header in headers:
        by_header.setdefault(header.columns, []).append(header.path)
    frames = []
    for columns, paths in by_header.items():
        wanted = [*spec.columns, *[c for c in columns if keep_extra and c not in spec.columns]]
        rows = (
            spark.read.schema(string_schema([*columns, RESCUED]))
            .option("header", True)
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUED)
            # Fields are only counted where all columns are read.
            .option("columnPruning", False)
            .option("multiLine", spec.multi_line)
            .csv(paths)
        )
        frames.append(rows.select(*wanted, RESCUED, F.col("_metadata.file_name").alias("_source_file")))
    return union_all(frames)


def with_lineage(
    df: DataFrame, spec: SourceSpec, batch_id: str, loaded_at: dt.datetime | None = None
) -> DataFrame:
    """The same lineage for batch and stream: load time, source system and batch id.

    ``_source_file`` comes with the rows; the rescue column is added where a source has none.
    """
    now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at.isoformat(sep=" "))
    added = {"_ingested_at": now.cast("timestamp"), "_source_system": F.lit(spec.system), BATCH: F.lit(batch_id)}
    if RESCUED not in df.columns:
        added[RESCUED] = F.lit(None).cast("string")
    return df.withColumns(added)


def read_bronze(spark: SparkSession, bronze: str, table: str, merge_schema: bool = True) -> DataFrame:
    """A bronze table; columns that only some batches have are null in the others."""
    path = f"{bronze.rstrip('/')}/{table}"
    found = spark.read.option("mergeSchema", merge_schema).parquet(path).schema
    # The batch id is a folder name: keep it text, whatever it looks like.
    fields = [T.StructField(f.name, T.StringType() if f.name == BATCH else f.dataType) for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_batches(spark: SparkSession, bronze: str, table: str, batches: Sequence[str]) -> DataFrame:
    """Some batches of a bronze table: nothing of the others is opened, not even for the schema."""
    path = f"{bronze.rstrip('/')}/{table}"
    if not batches:
        return read_bronze(spark, bronze, table).limit(0)
    folders = [f"{path}/{name}" for name in batch_folders(spark, path, batches)]
    found = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == BATCH else f.dataType) for f in found]
    return spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(*folders)


def batch_folders(spark: SparkSession, path: str, batches: Sequence[str]) -> list[str]:
    """Folder names of the batches; Spark escapes special characters in them."""
    wanted = set(batches)
    return [f for f in child_folders(spark, path) if f.startswith(f"{BATCH}=") and unquote(f.split("=", 1)[1]) in wanted]


def batch_signatures(spark: SparkSession, bronze: str, table: str) -> dict[str, str]:
    """Batch id -> digest of its files' names and lengths: a batch that is written anew gets another one.

    The files are listed and added up by tasks; one row per batch comes back.
    """
    path = f"{bronze.rstrip('/')}/{table}"
    if not exists(spark, path):
        return {}
    folder = F.regexp_extract("path", f"/{BATCH}=([^/]*)/[^/]*$", 1)
    mark = F.xxhash64(F.substring_index("path", "/", -1), "length")
    marks = file_sizes(spark, path).groupBy(folder.alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("mark")
    )
    rows = marks.select("batch", F.lower(F.hex(F.xxhash64("n", "mark"))).alias("mark")).collect()
    return {unquote(unquote(row["batch"])): row["mark"] for row in rows}


# --- writing ---------------------------------------------------------------------------------------


def write_bronze(df: DataFrame, bronze: str, table: str, mode: str) -> None:
    """``overwrite`` replaces the table, ``append`` only this batch's folder: a replay of a batch id
    rewrites what it wrote before instead of adding to it."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown load mode {mode!r}")
    dynamic = "dynamic" if mode == "append" else "static"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", dynamic)
    writer.option("compression", CODEC).partitionBy(BATCH).parquet(f"{bronze.rstrip('/')}/{table}")


def summarise(df: DataFrame) -> DataFrame:
    """Row, rescued-row, batch and file counts and the load times of a bronze frame, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(RESCUED).isNotNull()).alias("rescued_row_count"),
        F.countDistinct(BATCH).alias("batch_count"),
        F.countDistinct("_source_file").alias("file_count"),
        F.min("_ingested_at").alias("first_ingested_at"),
        F.max("_ingested_at").alias("latest_ingested_at"),
    )


def _append_log(rows: DataFrame, bronze: str, log: str, table: str) -> None:
    """Append to one table's folder of a log: extracts load side by side, and two jobs must not
    commit into the same folder at once."""
    rows.coalesce(1).write.mode("append").parquet(f"{bronze.rstrip('/')}/{log}/_source_table={table}")


def read_log(spark: SparkSession, bronze: str, log: str) -> DataFrame:
    """``ingest_audit``, ``ingest_quarantine`` or ``ingest_files`` of all tables."""
    return spark.read.parquet(f"{bronze.rstrip('/')}/{log}")


def quarantine(spark: SparkSession, bronze: str, table: str, problems: Sequence[tuple[str, str]]) -> None:
    """Record ``(file, reason)`` of everything of a table that was skipped."""
    if problems:
        rows = spark.createDataFrame(list(problems), "_source_file string, _reason string")
        rows = rows.select(F.current_timestamp().alias("_quarantined_at"), "*")
        _append_log(rows, bronze, "ingest_quarantine", table)


def unseen_files(spark: SparkSession, files: DataFrame, bronze: str, table: str) -> DataFrame:
    """Files not loaded before. A file is the same file if path, size and change time agree, so a
    new delivery under an old name loads."""
    ledger = f"{bronze.rstrip('/')}/ingest_files/_source_table={table}"
    if not exists(spark, ledger):
        return files
    loaded = spark.read.parquet(ledger)
    return files.join(loaded, ["path", "length", "modificationTime"], "left_anti")


def load_files(
    spark: SparkSession,
    spec: SourceSpec,
    files: Sequence,
    bronze: str,
    batch_id: str,
    mode: str = "append",
    loaded_at: dt.datetime | None = None,
    keep_extra: bool = True,
) -> Load:
    """Load the listed files (rows of ``FILE_SCHEMA``) as one batch; bad headers go to quarantine."""
    headers = read_headers(spark, spec, [f["path"] for f in files])
    bad = [(h.path.rsplit("/", 1)[-1], h.problem) for h in headers if h.problem]
    good = [h for h in headers if not h.problem]
    quarantine(spark, bronze, spec.table, bad)
    if not good:
        problem = "; ".join(f"{name}: {reason}" for name, reason in bad) or None
        return Load(spec.table, spec.system, batch_id, 0, 0, 0, mode, problem)
    rows = with_lineage(read_raw(spark, spec, good, keep_extra), spec, batch_id, loaded_at)
    write_bronze(rows, bronze, spec.table, mode)

    ok = {h.path for h in good}
    entries = [(batch_id, f["path"], f["modificationTime"], f["length"]) for f in files if f["path"] in ok]
    ledger = spark.createDataFrame(
        entries, "_batch_id string, path string, modificationTime timestamp, length long"
    )
    if mode == "overwrite":
        # What was loaded before is gone from the table, so it may be loaded again.
        path = f"{bronze.rstrip('/')}/ingest_files/_source_table={spec.table}"
        ledger.coalesce(1).write.mode("overwrite").parquet(path)
    else:
        _append_log(ledger, bronze, "ingest_files", spec.table)
    # Three narrow columns of the one batch folder: counts what this batch wrote, nothing else.
    written = read_bronze(spark, bronze, spec.table, merge_schema=False).filter(F.col(BATCH) == batch_id)
    counted = summarise(written).first()
    return Load(
        spec.table, spec.system, batch_id, counted["row_count"], counted["rescued_row_count"], len(good), mode
    )


def load_batch(
    spark: SparkSession,
    spec: SourceSpec,
    landing: str,
    bronze: str,
    mode: str = "append",
    batch_id: str | None = None,
    loaded_at: dt.datetime | None = None,
    keep_extra: bool = True,
) -> Load:
    """Load what lies in the landing folder: everything (``overwrite``) or what is new (``append``)."""
    batch_id = batch_id or new_batch_id()
    try:
        files = list_files(spark, spec.path(landing))
    except AnalysisException as missing:
        raise FileNotFoundError(f"no file matches {spec.path(landing)}") from missing
    if mode == "append":
        files = unseen_files(spark, files, bronze, spec.table)
    return load_files(spark, spec, files.collect(), bronze, batch_id, mode, loaded_at, keep_extra)


def new_batch_id() -> str:
    return str(uuid.uuid4())


def ingest_all(
    spark: SparkSession,
    landing: str,
    bronze: str,
    system: str | None = None,
    mode: str = "append",
    batch_id: str | None = None,
    loaded_at: dt.datetime | None = None,
    keep_extra: bool = True,
) -> list[Load]:
    """Load every extract, or one system's, side by side; a failing extract is quarantined and the
    others go on. Returns a load for every extract, failed ones with their problem, and writes one
    audit row for each of the others."""
    batch_id = batch_id or new_batch_id()

    def one(spec: SourceSpec) -> Load:
        try:
            return load_batch(spark, spec, landing, bronze, mode, batch_id, loaded_at, keep_extra)
        except Exception as problem:  # any failure is this extract's alone
            skipped = (spec.pattern.rsplit("/", 1)[-1], str(problem))
            quarantine(spark, bronze, spec.table, [skipped])
            return Load(spec.table, spec.system, batch_id, 0, 0, 0, mode, str(problem))

    specs = sources(system)
    with ThreadPoolExecutor(max_workers=len(specs)) as pool:
        loads = list(pool.map(one, specs))
    write_audit(spark, bronze, [load for load in loads if not load.problem])
    return loads


def compact_bronze(spark: SparkSession, bronze: str, target: str) -> list[str]:
    """Copy every bronze table that exists into ``target`` with few files per batch folder.

    Batches keep their folders and the logs go with them, so loads may go on in the new place; the
    caller points ``bronze`` there. Returns the tables copied.
    """
    done = []
    for spec in sources():
        if exists(spark, f"{bronze.rstrip('/')}/{spec.table}"):
            rows = read_bronze(spark, bronze, spec.table).hint("rebalance", BATCH)
            write_bronze(rows, target, spec.table, "overwrite")
            for log in ("ingest_files", "ingest_audit", "ingest_quarantine"):
                folder = f"{log}/_source_table={spec.table}"
                if exists(spark, f"{bronze.rstrip('/')}/{folder}"):
                    kept = spark.read.parquet(f"{bronze.rstrip('/')}/{folder}")
                    kept.coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{folder}")
            done.append(spec.table)
    return done


# --- audit -----------------------------------------------------------------------------------------

_AUDIT_SCHEMA = (
    "_batch_id string, _source_system string, _row_count bigint, _rescued_row_count bigint, "
    "_file_count bigint, _load_mode string"
)


def write_audit(spark: SparkSession, bronze: str, loads: Sequence[Load]) -> None:
    """Append one row per table of a batch, counting that batch only."""
    for load in loads:
        row = (load.batch_id, load.system, load.row_count, load.rescued_row_count, load.file_count, load.mode)
        audit = spark.createDataFrame([row], _AUDIT_SCHEMA)
        audit = audit.withColumn("_loaded_at", F.current_timestamp())
        _append_log(audit, bronze, "ingest_audit", load.table)


def audit_totals(audit: DataFrame, batch_id: str) -> DataFrame:
    """Rows loaded per source system in one batch."""
    batch = audit.filter(F.col("_batch_id") == batch_id)
    totals = batch.groupBy("_source_system").agg(F.sum("_row_count").alias("rows_loaded"))
    return totals.orderBy("_source_system")


def assert_loaded(loads: Sequence[Load]) -> None:
    """Fail when a table got no rows, because its extract failed or was empty.

    An append or a stream that found no new file is no failure. Nor are rescued rows: they were kept.
    """
    empty = []
    for table in dict.fromkeys(load.table for load in loads):
        own = [load for load in loads if load.table == table]
        expected = any(load.problem or load.file_count or load.mode == "overwrite" for load in own)
        if expected and not any(load.row_count for load in own):
            empty.append(" ".join([table, *(f"({load.problem})" for load in own if load.problem)]))
    if empty:
        raise EmptyLoadError(f"no rows loaded into: {', '.join(empty)}")
