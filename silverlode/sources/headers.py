"""Header gate: every file must have the required columns before any of its rows are read.

Spark maps CSV columns by position under a declared schema, so a reordered file would load shifted
values. Here each file is read with its own header's column order and then selected by name.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from silverlode.sources.files import first_line
from silverlode.sources.specs import SourceSpec

_BOM = "﻿"
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)


@dataclass(frozen=True)
class FileHeader:
    path: str
    columns: tuple[str, ...]
    missing: tuple[str, ...]
    repeated: tuple[str, ...]

    @property
    def problem(self) -> str | None:
        if self.missing:
            return f"missing required column(s): {', '.join(self.missing)}"
        if self.repeated:
            return f"repeated column(s): {', '.join(self.repeated)}"
        return None


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``FILE_SCHEMA`` rows of the files below a path pattern. The content column of the binary
    source is not selected, so no file is opened."""
    return spark.read.format("binaryFile").load(path).select(*FILE_SCHEMA.names)


def parse_header(line: str, path: str, spec: SourceSpec) -> FileHeader:
    """Column names of a header line: byte-order mark, quotes and padding removed."""
    names = tuple(n.strip().strip('"').strip() for n in line.lstrip(_BOM).rstrip("\r\n").split(","))
    missing = tuple(c for c in spec.columns if c not in names)
    repeated = tuple(sorted({n for n in names if names.count(n) > 1}))
    return FileHeader(path, names, missing, repeated)


def read_headers(spark: SparkSession, spec: SourceSpec, paths: Iterable[str]) -> list[FileHeader]:
    """Headers of the new files of one load. Only the first line of each file is fetched, with many
    requests in flight; the rows themselves are never read for this."""
    with ThreadPoolExecutor(max_workers=32) as pool:
        return list(pool.map(lambda p: parse_header(first_line(spark, p), p, spec), paths))


def check_headers(spark: SparkSession, spec: SourceSpec, landing: str) -> DataFrame:
    """``(file, missing)`` for every file of an extract; ``missing`` is empty for a good file."""
    paths = [row["path"] for row in list_files(spark, spec.path(landing)).select("path").collect()]
    rows = [(h.path.rsplit("/", 1)[-1], list(h.missing)) for h in read_headers(spark, spec, paths)]
    return spark.createDataFrame(rows, "file string, missing array<string>")
