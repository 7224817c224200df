"""Shared small helpers: table access, ASCII lower-casing, row keys, let-bindings in expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the word definition: blank and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is (unlike ``lower``)."""
    return F.translate(column, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once: a lambda variable cannot be inlined by the optimizer."""
    return F.transform(F.array(value), body).getItem(0)


def row_key(*columns: str) -> Column:
    """128 bits that stand for the listed columns: rows that repeat share it, others do not.

    Nulls differ from empty texts, and lengths keep neighbouring columns apart.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return F.unhex(F.md5(F.concat_ws(":", *parts)))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in order, in parts of about ``limit`` bytes of ``column``, a longer text alone.

    Batches hold a number of rows, whatever their length; working memory follows the bytes.
    """
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths, dtype=np.int64) - lengths) // limit
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, end in zip(cuts, [*cuts[1:], len(part)], strict=True):
            yield batch.slice(start, end - start)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, from blocks of about ``size`` bytes that end between words.

    ``bytes.split`` parts at exactly the white space of the word definition.
    """
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        stop = space.start() if space else len(text)
        yield text[at:stop].split()
        at = stop
    yield (text[at:] if at else text).split()
