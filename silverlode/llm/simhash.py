"""Near-duplicate documents by SimHash fingerprints that differ in few bits, found by anchor points.

Anchors are the words of a covering code: every point lies within the code's radius of some anchor, its
home. If a fingerprint goes to its home and to every anchor within radius plus threshold, it meets the
home of each fingerprint within the threshold, so pairs need only be compared anchor by anchor.

Over 64 bits and three differing bits that would be ten thousand anchors for each fingerprint. But of the
two halves of a link one differs in one bit at most. So each half has its own code: a Hamming code of 31 bits,
which covers with radius 1, and one free bit. A fingerprint goes to its home and the anchors within
radius 1 + threshold 1 = 2: at most 17 for each half, and 2^27 anchors share the load.

Equal fingerprints are one from the start. An anchor with very many fingerprints is cut into blocks, every
pair of blocks a group of its own. A group leaves a chain through each set of fingerprints that it links, never
all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import slices, word_blocks
from silverlode.llm.near_dedup import components
from silverlode.session import stash


@dataclass(frozen=True)
class SimHashPlan:
    shingle: int = 3
    seed: int = 42
    #: Fingerprints of one anchor that are compared in one group.
    block_rows: int = 1 << 16
    #: Fingerprints with more than one row in so many are joined by broadcast: at most so many of them exist.
    heavy_share: int = 1000


#: Links differ in so many bits at most. The codes below rest on it: one half differs in one bit at most.
THRESHOLD = 3
_HALF = 32


# --- fingerprints ------------------------------------------------------------------------------------


def fingerprint(text: bytes, plan: SimHashPlan) -> int:
    """The majority of each bit over the hashes of all shingles of a lower-cased text, repeats included."""
    from xxhash import xxh64_intdigest

    ones, n = np.zeros(64, np.int64), 0

    def add(hashes: list[int]) -> int:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add(ones, bits.sum(axis=0, dtype=np.int64), out=ones)
        return len(hashes)

    before: list[bytes] = []
    for words in word_blocks(text):
        before += words
        if len(before) >= plan.shingle:
            joined = b" ".join(before)
            ends = np.cumsum(np.fromiter(map(len, before), np.int64, len(before)) + 1) - 1
            starts = [0, *(ends[: -plan.shingle] + 1).tolist()]
            parts = map(joined.__getitem__, map(slice, starts, ends[plan.shingle - 1 :].tolist()))
            n += add(list(map(xxh64_intdigest, parts, repeat(plan.seed))))
            before = before[len(before) - plan.shingle + 1 :]
    if not n:
        if not before:
            return 0
        n += add([xxh64_intdigest(b" ".join(before), plan.seed)])
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(rows: DataFrame, plan: SimHashPlan) -> DataFrame:
    """(id, fp) of each row of ``id`` and ``text``; the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # Bytes lower-case A-Z alone.
            texts = [(t or b"").lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            found = np.array([fingerprint(t, plan) for t in texts], np.uint64)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "fp": pa.array(found.view(np.int64))})

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(run, f"id {id_type}, fp bigint")


# --- anchors -----------------------------------------------------------------------------------------


def _pairs_by_syndrome() -> np.ndarray:
    """For each syndrome 1 to 31 the fifteen pairs of bits whose flips have it, as masks; row 0 is not used."""
    table = np.zeros((32, 15), np.uint32)
    for wanted in range(1, 32):
        pairs = [(a, a ^ wanted) for a in range(1, 32) if a < a ^ wanted]
        table[wanted] = [1 << (a - 1) | 1 << (b - 1) for a, b in pairs]
    return table


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for every anchor within distance 2 of each 32-bit number.

    An anchor is a word of the Hamming code in the lower 31 bits, with any highest bit. The syndrome of a number is
    the sum (exclusive or) of the places, counted from 1, of its set bits; words of the code have 0, and
    flipping bit ``s`` of a number with syndrome ``s`` gives its home.
    """
    half = half.astype(np.uint32)
    syndrome = np.zeros(len(half), np.uint32)
    for place in range(1, _HALF):
        syndrome ^= ((half >> np.uint32(place - 1)) & np.uint32(1)) * np.uint32(place)
    flip = np.where(syndrome > 0, np.uint32(1) << (np.maximum(syndrome, 1) - np.uint32(1)), np.uint32(0))
    home = half ^ flip
    rows = np.arange(len(half))
    off = np.flatnonzero(syndrome)
    second = half[off][:, None] ^ _pairs_by_syndrome()[syndrome[off]]
    return (
        np.concatenate([rows, rows, np.repeat(off, second.shape[1])]),
        np.concatenate([home, home ^ np.uint32(1 << 31), second.ravel()]),
        np.concatenate([np.ones(len(half), bool), np.zeros(len(half) + second.size, bool)]),
    )


def replicas(distinct: DataFrame) -> DataFrame:
    """(half, anchor, home, fp) for every fingerprint and every anchor that it goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for half in range(2):
                row, anchor, home = anchors(fp >> np.uint64(_HALF * half) & np.uint64((1 << _HALF) - 1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "half": pa.array(np.full(len(row), half, np.int8)),
                        "anchor": pa.array(anchor.astype(np.int64)),
                        "home": pa.array(home),
                        "fp": pa.array(fp[row].view(np.int64)),
                    }
                )

    return distinct.select("fp").mapInArrow(run, "half tinyint, anchor bigint, home boolean, fp bigint")


# --- links -------------------------------------------------------------------------------------------


def _distance(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other)


class _Sets:
    """Disjoint sets of the numbers from 0 on, as an array of labels' parents."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, one: np.ndarray, other: np.ndarray) -> None:
        """Hook the larger label of each pair below the smaller one until all pairs agree."""
        while True:
            a, b = self.parent[one], self.parent[other]
            if (a == b).all():
                return
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up


def cell_chains(fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that chain together the fingerprints of one anchor which pairs with a home among them link.

    ``fp`` ascends without repeats. First come the pairs one bit apart, by search; then every home is compared
    with all fingerprints that are not yet in its set.
    """
    sets = _Sets(len(fp))
    for bit in range(64):
        other = fp ^ np.uint64(1 << bit)
        at = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
        near = np.flatnonzero((fp[at] == other) & (home | home[at]))
        sets.join(near, at[near])
    for x in np.flatnonzero(home):
        far = np.flatnonzero(sets.parent != sets.parent[x])
        near = far[_distance(fp[far], fp[x]) <= THRESHOLD]
        if len(near):
            sets.join(np.full(len(near), x), near)
    order = np.argsort(sets.parent, kind="stable")
    chained = np.flatnonzero(sets.parent[order[1:]] == sets.parent[order[:-1]])
    return fp[order[chained]], fp[order[chained + 1]]


#: Cells up to this size are compared together, by distance in the sort order.
_SMALL = 48


def _chains() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over batches sorted by cell that finds the links (a, b) of each cell."""

    def of_cells(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        start = np.concatenate([[0], cut])
        size = np.diff(np.concatenate([start, [len(fp)]]))
        cell = np.repeat(np.arange(len(start)), size)
        alive = np.logical_or.reduceat(home, start) & (size > 1)
        small = np.flatnonzero((alive & (size <= _SMALL))[cell])
        one, other = [], []
        held, mine, known = fp[small], cell[small], home[small]
        for apart in range(1, _SMALL):
            if apart >= len(held):
                break
            pair = np.flatnonzero((mine[apart:] == mine[:-apart]) & (known[apart:] | known[:-apart]))
            if not len(pair):
                # Homes may stand further apart, but cells end at their own size.
                if not (mine[apart:] == mine[:-apart]).any():
                    break
                continue
            near = pair[(_distance(held[pair], held[pair + apart]) <= THRESHOLD) & (held[pair] != held[pair + apart])]
            one.append(held[near])
            other.append(held[near + apart])
        for n in np.flatnonzero(alive & (size > _SMALL)):
            part = slice(start[n], start[n] + size[n])
            # A home of a cell that is cut in blocks comes twice where its own block meets itself.
            each, first = np.unique(fp[part], return_index=True)
            a, b = cell_chains(each, np.logical_or.reduceat(home[part], first))
            one.append(a)
            other.append(b)
        if one:
            a, b = np.concatenate(one).view(np.int64), np.concatenate(other).view(np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("half", "anchor", "i", "j")], axis=1)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            home = batch.column("home").to_numpy(zero_copy_only=False)
            breaks = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            if waiting and (waiting[-1][0][-1] != key[0]).any():
                yield from of_cells(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting = []
            last = int(breaks[-1]) + 1 if len(breaks) else 0
            if last:
                waiting.append((key[:last], fp[:last], home[:last]))
                yield from of_cells(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting = []
            waiting.append((key[last:], fp[last:], home[last:]))
        if waiting:
            yield from of_cells(*map(np.concatenate, zip(*waiting, strict=True)))

    return run


def links(distinct: DataFrame, plan: SimHashPlan) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints ``THRESHOLD`` bits apart or less."""
    rows = replicas(distinct)
    cuts = rows.groupBy("half", "anchor").agg(F.count("*").alias("n")).filter(F.col("n") > plan.block_rows)
    cuts = stash(cuts.select("half", "anchor", F.ceil(F.col("n") / plan.block_rows).cast("int").alias("blocks")), "crowded-anchors")
    dealt = rows.join(cuts, ["half", "anchor"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # Homes of block i meet the fingerprints of block j in the cell (i, j).
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_home = F.transform(others, lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(True).alias("home")))
    as_other = F.transform(others, lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(False).alias("home")))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("home")))
    places = F.when(F.col("blocks") == 1, whole).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    placed = dealt.select("half", "anchor", "fp", F.explode(places).alias("place"))
    cells = placed.select("half", "anchor", "place.i", "place.j", "place.home", "fp")
    cells = cells.repartition("half", "anchor", "i", "j").sortWithinPartitions("half", "anchor", "i", "j", "fp")
    return cells.mapInArrow(_chains(), "a bigint, b bigint").distinct()


# --- documents ---------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, plan: SimHashPlan = SimHashPlan(), *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: its id, ``fp`` (64 bits as a signed number) and ``component_id``.

    Rows are linked if their fingerprints differ in three bits or fewer. Words end at blanks and control
    characters, A-Z is lower-cased; a text with fewer words than a shingle is one shingle, and null, empty and
    blank texts have the fingerprint 0, which is linked like any other. ``component_id`` is the least id of
    the component; rows without an id never give it, but belong to components. Rows that repeat get equal
    results; an empty table gives an empty one. Only the two columns named are read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    signed = stash(fingerprints(rows, plan), "fingerprints")
    distinct = stash(signed.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n")), "distinct-fingerprints")
    labels = components(stash(links(distinct, plan), "fingerprint-links"))
    labelled = distinct.join(labels.withColumnRenamed("class", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    # Linked fingerprints only need the least id of others; the rest have their own.
    least = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    named = stash(labelled.join(least, "label").select("fp", "n", "component_id"), "fingerprint-components")

    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = F.col("n") * plan.heavy_share > total
    # Fewer than ``heavy_share`` fingerprints can be heavy, so this broadcast has a proven bound.
    common = signed.join(F.broadcast(named.filter(heavy).select("fp", "component_id")), "fp")
    rare = signed.join(F.broadcast(named.filter(heavy).select("fp")), "fp", "left_anti")
    both = common.unionByName(rare.join(named.filter(~heavy).select("fp", "component_id"), "fp"))
    return both.select(F.col("id").alias(id_column), "fp", "component_id")
