"""Removal of lines that many documents share, with two Bloom filters before the exact count.

One pass fills the filters of line hashes seen once and seen twice. A second pass sends only lines whose
hash the second filter holds to the exact count by a 128-bit digest, which partial aggregates shrink
where a line is very frequent. The lines to drop then meet their documents again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm import bloom
from silverlode.llm.common import SPACES, row_key, slices
from silverlode.session import stash


@dataclass(frozen=True)
class LineDedupPlan:
    min_chars: int = 40
    min_docs: int = 5
    #: Bound of the filter in bits: 32 MB. Beyond some thirty million lines more lines are suspected than repeat.
    max_cells: int = 1 << 28


def line_digests(text: str, min_chars: int) -> dict[bytes, list[int]]:
    """Digest of every key that is long enough, with the numbers of its lines."""
    found: dict[bytes, list[int]] = {}
    for n, line in enumerate(text.split("\n")):
        key = line.strip(SPACES)
        if len(key) >= min_chars:
            # Bytes lower-case A-Z alone.
            digest = hashlib.blake2b(key.encode().lower(), digest_size=16).digest()
            found.setdefault(digest, []).append(n)
    return found


def _hashes(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8")[::2]


def suspected_lines(texts: DataFrame, plan: LineDedupPlan) -> DataFrame:
    """(digest, id, key, lines) for each key and document that the filter of repeats holds.

    ``texts`` holds ``id``, ``key`` (of the row) and ``text``.
    """
    n_lines = texts.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        return _hashes([d for t in batch.column("text").to_pylist() for d in line_digests(t, plan.min_chars)])

    cells = bloom.cells_for(n_lines, plan.max_cells)
    _, twice = bloom.build(texts.select("text"), hashes, cells)
    repeats = texts.sparkSession.sparkContext.broadcast(twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, digests, lines = [], [], []
            for n, text in enumerate(batch.column("text").to_pylist()):
                for digest, numbers in line_digests(text, plan.min_chars).items():
                    rows.append(n)
                    digests.append(digest)
                    lines.append(numbers)
            held = np.flatnonzero(bloom.contains(repeats.value, _hashes(digests)))
            picked = pa.array(np.array(rows, np.int64)[held])
            yield pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array([digests[i] for i in held], pa.binary()),
                    "id": batch.column("id").take(picked),
                    "key": batch.column("key").take(picked),
                    "lines": pa.array([lines[i] for i in held], pa.list_(pa.int32())),
                }
            )

    id_type = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "key", "text").mapInArrow(run, f"digest binary, id {id_type}, key binary, lines array<int>")


def drop_repeated_lines(
    docs: DataFrame,
    plan: LineDedupPlan = LineDedupPlan(),
    *,
    id_column: str = "doc_id",
    text: str = "text",
    out: str = "lines",
) -> DataFrame:
    """``docs`` with a struct ``out``: the text that stays, ``n_lines`` before and ``n_dropped``.

    A key found under ``min_docs`` different ids or more keeps its lines in the largest of them only. A
    null or empty text is one empty line and becomes an empty text. Rows that repeat an id count as one
    document and are treated alike; rows without an id never count nor keep. An empty table gives an
    empty one. ``out`` replaces a column of that name, other columns may have any name.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), row_key(id_column, text).alias("key"), content.alias("text"))
    suspects = stash(suspected_lines(rows, plan), "suspected-lines")
    repeated = (
        suspects.groupBy("digest")
        .agg(F.count_distinct("id").alias("n"), F.max("id").alias("keeper"))
        .filter(F.col("n") >= plan.min_docs)
        .select("digest", "keeper")
    )
    drops = (
        suspects.join(repeated, "digest")
        .filter(F.col("id").isNull() | (F.col("id") != F.col("keeper")))
        .groupBy("key")
        .agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("drops"))
    )

    @F.arrow_udf("string")
    def without(texts: pa.Array, drops: pa.Array) -> pa.Array:
        kept = []
        for given, numbers in zip(texts.to_pylist(), drops.to_pylist(), strict=True):
            gone = set(numbers or ())
            kept.append(None if given is None else "\n".join(x for n, x in enumerate(given.split("\n")) if n not in gone))
        return pa.array(kept, pa.string())

    left = [c for c in docs.columns if c != out]
    keyed = docs.select(F.struct(*left).alias("row"), content.alias("text"), row_key(id_column, text).alias("key"))
    joined = keyed.join(drops, "key", "left")
    # Only texts that lose lines pass through Python.
    changed = without(F.when(F.col("drops").isNotNull(), F.col("text")), F.col("drops"))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        "row.*",
        F.struct(
            F.coalesce(changed, F.col("text")).alias("text"),
            lines.cast("bigint").alias("n_lines"),
            F.coalesce(F.size("drops"), F.lit(0)).cast("bigint").alias("n_dropped"),
        ).alias(out),
    )


def clean_lines(docs: DataFrame, plan: LineDedupPlan = LineDedupPlan(), *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated lines gone from their texts; null texts stay null."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"))
    done = drop_repeated_lines(rows, plan, id_column="id", text="text", out="lines")
    kept = F.when(F.col("text").isNotNull(), F.col("lines.text")).alias(text)
    return done.select(*(kept if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
