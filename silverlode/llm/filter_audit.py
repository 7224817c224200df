"""What each of five document filters removes, alone and after others, for every order of the filters.

Every document gets a mask of the filters it fails; what is kept after some filters depends only on how
many documents of each part have each mask. So one aggregate leaves at most 32 cells for each part, and
a walk through all 32 sets of filters in Gray-code order, one filter switched at a time, finds the
survivors of each set: a cell counts its failing filters that are switched on and leaves or rejoins the
survivors when that count leaves or reaches zero. Each step of each order is a difference of two sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import slices, word_blocks
from silverlode.session import stash


@dataclass(frozen=True)
class AuditPlan:
    #: A: fewer words.
    min_words: int = 50
    #: B: fewer distinct words, in per cent of the words.
    min_distinct: int = 65
    #: C: more capital letters, in per cent of the code points.
    max_capitals: int = 5
    #: D: one of these characters.
    symbols: bytes = b"#$%&*|"


FILTERS = "ABCDE"
_CAPITALS = bytes(range(0x41, 0x5B))
_FOLLOWING = bytes(range(0x80, 0xC0))


def failures(text: bytes, plan: AuditPlan) -> int:
    """The filters A to D that a text fails, as bits."""
    n_words, seen = 0, set()
    for words in word_blocks(text):
        n_words += len(words)
        seen.update(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    characters = len(text.translate(None, _FOLLOWING))
    return (
        (n_words < plan.min_words)
        | (100 * len(seen) < plan.min_distinct * n_words) << 1
        | (100 * capitals > plan.max_capitals * characters) << 2
        | (len(text.translate(None, plan.symbols)) < len(text)) << 3
    )


def masks(rows: DataFrame, plan: AuditPlan) -> DataFrame:
    """(id, part, digest, mask) of each row of ``id``, ``part`` and ``text``: filters A to D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "part": batch.column("part"),
                    "digest": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    "mask": pa.array([failures(t, plan) for t in texts], pa.int32()),
                }
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "part", "text").mapInArrow(run, f"id {id_type}, part string, digest binary, mask int")


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    plan: AuditPlan = AuditPlan(),
    *,
    id_column: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail exactly the filters of ``mask``.

    Filter E fails a row if a smaller id has the same text anywhere in the table. Null texts are empty, null
    parts are the part of the empty text. Rows that repeat an id fail E alike; rows without an id neither fail
    E nor make others fail, and have no labels. A row is good (toxic) if any label of its id says so.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    # Rows that repeat whole become one before anything is joined.
    counted = masks(rows, plan).groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    counted = stash(counted, "audit-masks")
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    named = counted.filter("id is not null").join(marks, "id", "left")
    firsts = counted.filter("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    # By text and id, so the copies of one text spread over all tasks.
    named = named.join(firsts.withColumn("first", F.lit(True)), ["digest", "id"], "left")
    late = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    named = named.select("part", (F.col("mask") + late).alias("mask"), "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    nameless = counted.filter("id is null").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return (
        named.unionByName(nameless)
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    )


def survivors(cells: dict[int, np.ndarray], filters: int = len(FILTERS)) -> list[np.ndarray]:
    """What is left of the cells under each set of filters; sets are masks, cells map masks to counts."""
    active = dict.fromkeys(cells, 0)
    running = sum(cells.values())
    states = [running] * (1 << filters)
    chosen = 0
    for step in range(1, 1 << filters):
        # The filter to switch is the lowest set bit of the step.
        switched = step & -step
        chosen ^= switched
        change = 1 if chosen & switched else -1
        for mask, counts in cells.items():
            if mask & switched:
                active[mask] += change
                if change == 1 and active[mask] == 1:
                    running = running - counts
                elif change == -1 and active[mask] == 0:
                    running = running + counts
        states[chosen] = running
    return states


def _steps(table: pa.Table) -> pa.Table:
    """The rows of one part from its cells, 32 at most."""
    counts = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
    cells = dict(zip(table.column("mask").to_pylist(), counts, strict=True))
    states = survivors(cells)
    fails = [sum(int(c[0]) for m, c in cells.items() if m >> f & 1) for f in range(len(FILTERS))]
    alone = [int(cells[1 << f][0]) if 1 << f in cells else 0 for f in range(len(FILTERS))]
    out, total = [], [0] * len(FILTERS)
    for order in permutations(range(len(FILTERS))):
        before, name = 0, "".join(FILTERS[f] for f in order)
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            total[f] += removed
            out.append((name, step, int(states[after][0]), removed, fails[f] - removed, alone[f], good, toxic, f))
            before = after
    names = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    columns = dict(zip((*names, "filter"), map(list, zip(*out, strict=True)), strict=True))
    shapley = [total[f] for f in columns.pop("filter")]
    part = pa.array([table.column("part")[0].as_py()] * len(out), pa.string())
    columns["step"] = pa.array(columns["step"], pa.int32())
    return pa.table({"part": part, **columns, "shapley": shapley})


def audit(cells: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from ``mask_cells``; none for an empty table.

    ``kept`` is left after the step, ``removed`` goes in it; ``redundant`` fails the step's filter but went
    earlier, ``unique_fails`` fails it and no other. ``shapley`` is what the filter removes in all orders together.
    """
    schema = (
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
        "good_lost bigint, toxic_lost bigint, shapley bigint"
    )
    return cells.groupBy("part").applyInArrow(_steps, schema)
