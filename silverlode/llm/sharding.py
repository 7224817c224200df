"""Shards of near equal size from indivisible groups of documents, by best-fit decreasing.

Documents with equal texts form a group. Groups are sized by an aggregate; the few large ones are packed
first, together, and the small ones in batches of bounded size, each against its share of the room that
the large ones left. Within a pack, groups enter the tightest bin with room, found in a balanced tree
(a treap) over the free capacities.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.session import stash


@dataclass(frozen=True)
class ShardPlan:
    shards: int = 16
    #: A group is large if it has more than this part of a shard: at most ``shards * large_parts`` groups are.
    large_parts: int = 64
    #: Small groups in a batch, on average.
    batch_groups: int = 20_000
    #: Rows of one shard that are numbered together, on average.
    slot_rows: int = 5_000


class FreeBins:
    """Bins ordered by free capacity: a treap of (free, bin) keys."""

    def __init__(self) -> None:
        self._root: list | None = None
        self._random = random.Random(1)

    def _split(self, node, key):
        """Trees of the keys below ``key`` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[2], right = self._split(node[2], key)
            return node, right
        left, node[1] = self._split(node[1], key)
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[3] > b[3]:
            a[2] = self._join(a[2], b)
            return a
        b[1] = self._join(a, b[1])
        return b

    def add(self, free: int, number: int) -> None:
        left, right = self._split(self._root, (free, number))
        self._root = self._join(self._join(left, [(free, number), None, None, self._random.random()]), right)

    def _pop(self, key) -> tuple[int, int] | None:
        """Take out the smallest key from ``key`` on."""
        left, right = self._split(self._root, key)
        found = right
        while found is not None and found[1] is not None:
            found = found[1]
        if found is None:
            self._root = left
            return None
        _, rest = self._split(right, (found[0][0], found[0][1] + 1))
        self._root = self._join(left, rest)
        return found[0]

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least free capacity that has room for ``size``."""
        return self._pop((size, -1))

    def roomiest(self) -> tuple[int, int]:
        node = self._root
        while node[2] is not None:
            node = node[2]
        return self._pop(node[0])


def best_fit_decreasing(sizes: Sequence[int], capacities: Sequence[int], grow: int | None = None) -> list[int]:
    """The bin of every item. What fits nowhere opens a bin of capacity ``grow``, or without it enters the roomiest.

    Ties of sizes go by position.
    """
    free, bins = FreeBins(), len(capacities)
    for number, capacity in enumerate(capacities):
        free.add(capacity, number)
    placed = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = free.tightest(sizes[item])
        if found is None and grow is not None:
            found = (grow, bins)
            bins += 1
        elif found is None:
            found = free.roomiest()
        placed[item] = found[1]
        free.add(found[0] - sizes[item], found[1])
    return placed


def _packed(groups: DataFrame, by: Column, capacities: Sequence[int], total: int) -> DataFrame:
    """(id, piece, shard) of ``groups``, packed by themselves in each value of ``by``.

    Each pack gets its share of the capacities, in proportion to its bytes.
    """

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array([x.as_py() for x in table.column("order")]), kind="stable")
        table = table.take(pa.array(order))
        sizes = table.column("bytes").to_pylist()
        share = sum(sizes) / max(1, total)
        shards = best_fit_decreasing(sizes, [int(c * share) for c in capacities])
        return pa.table({"id": table.column("id"), "piece": table.column("piece"), "shard": pa.array(shards, pa.int32())})

    rows = groups.select("id", "piece", "bytes", F.hex("id").alias("order"), by.alias("pack"))
    return rows.groupBy("pack").applyInArrow(run, "id binary, piece int, shard int")


def shard_groups(groups: DataFrame, plan: ShardPlan) -> DataFrame:
    """(id, piece, shard) of every group of ``id``, ``piece`` and ``bytes``."""
    total, n = groups.agg(F.sum("bytes"), F.count("*")).first()
    total = int(total or 0)
    capacity = total // plan.shards
    edge = capacity // plan.large_parts
    large = groups.filter(F.col("bytes") > edge)
    placed = stash(_packed(large, F.lit(0), [capacity + 1] * plan.shards, total=_sum(large)), "large-groups")
    loads = dict(placed.join(large, ["id", "piece"]).groupBy("shard").agg(F.sum("bytes")).collect())
    room = [max(0, capacity - int(loads.get(s, 0))) for s in range(plan.shards)]
    small = groups.filter(F.col("bytes") <= edge)
    batches = 1 + n // plan.batch_groups
    by = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    return placed.unionByName(_packed(small, by, room, total=sum(room)))


def _sum(groups: DataFrame) -> int:
    return int(groups.agg(F.sum("bytes")).first()[0] or 0)


def assign_shards(
    docs: DataFrame, plan: ShardPlan = ShardPlan(), *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row's id, ``size``, ``text_crc32``, ``shard`` and ``slot`` (its place in the shard, gapless from 0).

    Size: UTF-8 bytes and 1. Null texts count as empty ones. Equal texts share a shard, unless together
    they are larger than a shard: then they are dealt over pieces of a quarter of it, as no placement of the
    whole could be even; rows are numbered first, so that rows that repeat an id are spread, too. Rows that
    repeat get a slot each. An empty table gives an empty result.
    Other columns are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("crc"),
        F.unhex(F.md5(content)).alias("id"),
    )
    whole = stash(rows.groupBy("id").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "text-groups")
    total, n_rows = whole.agg(F.sum("bytes"), F.sum("n")).first()
    capacity = int(total or 0) // plan.shards
    # Fewer than ``shards`` groups can be larger than a shard.
    oversize = whole.filter((F.col("bytes") > capacity) & (F.col("n") > 1)).select("id", "bytes").collect()
    piece = F.lit(0)
    if oversize:
        # Stored, so that a row keeps its number.
        rows = stash(rows.withColumn("number", F.monotonically_increasing_id()), "numbered-rows")
    for row in oversize:
        pieces = -(-4 * row.bytes // max(1, capacity))
        dealt = F.pmod(F.xxhash64("doc", "number"), F.lit(pieces)).cast("int")
        piece = F.when(F.col("id") == F.lit(row.id), dealt).otherwise(piece)
    rows = rows.withColumn("piece", piece)
    if oversize:
        groups = stash(rows.groupBy("id", "piece").agg(F.sum("size").alias("bytes")), "text-groups")
    else:
        groups = whole.select("id", F.lit(0).alias("piece"), "bytes")
    shards = shard_groups(groups, plan)

    # Rows are numbered in many small buckets of each shard, and a bucket's first number is the sum of those before it.
    buckets = 1 + int(n_rows or 0) // (plan.shards * plan.slot_rows)
    spread = F.xxhash64("doc", "crc", "size", F.monotonically_increasing_id())
    bucket = F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket")
    placed = stash(rows.join(shards, ["id", "piece"]).select("doc", "size", "crc", "shard", bucket), "sharded-rows")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = "sum(n) over (partition by shard order by bucket rows between unbounded preceding and current row) - n"
    starts = counts.select("shard", "bucket", F.expr(before).alias("before"))
    number = "row_number() over (partition by shard, bucket order by doc, crc, size) - 1"
    numbered = placed.select("doc", "size", "crc", "shard", "bucket", F.expr(number).alias("number"))
    return numbered.join(starts, ["shard", "bucket"]).select(
        F.col("doc").alias(id_column),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("number") + F.col("before")).alias("slot"),
    )
