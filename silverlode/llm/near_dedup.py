"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on the full shingle sets.

Documents with equal sets form a class; the rest works on one row per class. A forest holds each class in
several sorted orders of its signature, an order starting at another place of it. Close classes share a
long prefix in some order and stand near each other there, however dense their region is; the depth that
two neighbours share adapts to the region by itself. Orders are range-partitioned by the whole order, so
a region of any size spreads over tasks; rows at the borders of the ranges meet in a further step.

Candidates with similar sketches are confirmed in rounds: first the most similar of each class, then what
is left between different components, then neighbours further off that are still in different components;
those must look similar by a finer sketch too, which only classes with candidates have. Regions (rows of an
order that share its least depth) longer than the reach are then compared whole: cut into blocks, every pair
of blocks in a group of its own, every pair of different components by its full sets.
Components are found by hooking and pointer jumping on tables, never on the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import row_key, slices
from silverlode.llm.wordhash import SOLID, Words, runs, words_of
from silverlode.session import stash


@dataclass(frozen=True)
class NearDedupPlan:
    shingle: int = 2
    #: Links need this per cent of the union in common.
    percent: int = 80
    trees: int = 16
    #: Signature values: each tree starts ``values / trees`` places after the one before.
    values: int = 64
    #: Values in a tree's order, and how many of them neighbours share at least.
    depth: int = 6
    least_depth: int = 3
    #: Rows of an order that are compared with those after them; the next ones are candidates at once. Longer
    #: regions are compared whole afterwards, in blocks of about so many rows and bytes of full sets.
    reach: int = 32
    close: int = 1
    #: Equal quarter-bytes of two signatures that make a candidate: a link of 80 per cent has fewer once in a million.
    least_equal: int = 36
    #: More values for the classes that have candidates; pairs of neighbours further off must pass these as well.
    fine: int = 256
    seed: int = 7
    block_rows: int = 2048
    block_bytes: int = 16 << 20


def least_equal(values: int, percent: int, miss: float = 1e-6) -> int:
    """The number of equal quarter-bytes that a link has in all but ``miss`` of the cases: a binomial tail."""
    p = percent / 100 + (1 - percent / 100) / 16
    if p >= 1:
        return values
    below = 0.0
    for k in range(values + 1):
        ways = math.lgamma(values + 1) - math.lgamma(k + 1) - math.lgamma(values - k + 1)
        below += math.exp(ways + k * math.log(p) + (values - k) * math.log1p(-p))
        if below > miss:
            return k
    return values


def _seeds(seed: int, values: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(seed))
    a = random.integers(0, 1 << 63, values, np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], random.integers(0, 1 << 63, values, np.uint64)[:, None]


def _sketch(values: np.ndarray) -> np.ndarray:
    """Four bits of each value, two values in a byte."""
    nibbles = (values & 15).astype(np.uint8)
    return nibbles[..., ::2] | (nibbles[..., 1::2] << 4)


def signature(shingles: np.ndarray, seeds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash function, as unsigned 32-bit numbers."""
    a, b = seeds
    least = None
    for at in range(0, len(shingles), 4096):
        part = ((shingles[None, at : at + 4096] * a + b) >> np.uint64(32)).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return least.astype(np.uint32)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; shorter texts are one shingle."""
    first, hashes = runs(words, size)
    text = words.text[first]
    for fewer in range(1, size):
        at, more = runs(words, fewer)
        whole = words.counts[words.text[at]] == fewer
        text, hashes = np.concatenate([text, words.text[at[whole]]]), np.concatenate([hashes, more[whole]])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    text, hashes = text[fresh], hashes[fresh]
    return np.split(hashes, np.searchsorted(text, np.arange(1, len(words.counts))))


def _binary(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def signatures(rows: DataFrame, plan: NearDedupPlan) -> DataFrame:
    """(id, key, n_shingles, class, signature) of each row of ``id``, ``key`` and ``text``; null class without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _seeds(plan.seed, plan.values)
        for batch in slices(batches):
            sets = shingle_sets(words_of(_binary(batch.column("text")), SOLID), plan.shingle)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "key": batch.column("key"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "class": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    "signature": pa.array([signature(s, seeds).tobytes() if len(s) else None for s in sets], pa.binary()),
                }
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "key", "text").mapInArrow(run, f"id {id_type}, key binary, n_shingles bigint, class binary, signature binary")


def forest(classes: DataFrame, plan: NearDedupPlan) -> DataFrame:
    """A row per class and tree: (tree, order, class, sketch, label).

    ``order`` holds the tree's values so that bytes sort as they do; ``sketch`` four bits of every value,
    and after them the column ``fine`` if the classes have one.
    """
    step = plan.values // plan.trees
    fine = F.col("fine") if "fine" in classes.columns else F.lit(b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(n, plan.values)
            more = batch.column("fine").to_pylist()
            sketches = pa.array([x.tobytes() + y for x, y in zip(_sketch(values), more, strict=True)], pa.binary())
            for tree in range(plan.trees):
                picked = [(tree * step + k) % plan.values for k in range(plan.depth)]
                order = np.ascontiguousarray(values[:, picked].astype(">u4"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array(np.full(n, tree, np.int32)),
                        "order": pa.array([x.tobytes() for x in order], pa.binary()),
                        "class": batch.column("class"),
                        "sketch": sketches,
                        "label": batch.column("label"),
                    }
                )

    return classes.select("class", "signature", "label", fine.alias("fine")).mapInArrow(
        run, "tree int, order binary, class binary, sketch binary, label binary"
    )


_FOUND = "a binary, b binary, equal int, tree int, order binary, sketch binary, label binary"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _neighbours(plan: NearDedupPlan, emit: int, borders: bool, fine: bool):
    """A function over sorted batches that finds pairs of neighbours with different labels and similar sketches.

    Pairs at most ``emit`` rows apart come out as (a, b, equal); of those further off, up to ``reach``, only
    the classes (b null). ``borders`` adds the first and last ``reach`` rows of the partition, whole.
    ``fine``: the sketches hold the finer values too, and pairs must pass both bounds; rows with more than
    ``reach`` rows of their region before them are left out then, as regions of that length are compared whole.
    """
    zeros = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)
    least = 4 * plan.least_depth
    coarse = plan.values // 2
    least_all = least_equal(plan.values + plan.fine, plan.percent)

    def found(a: pa.Array, b: pa.Array | None, equal: np.ndarray | None, rows: pa.RecordBatch | None = None) -> pa.RecordBatch:
        n = len(a)
        columns = {
            "a": a,
            "b": pa.nulls(n, pa.binary()) if b is None else b,
            "equal": pa.nulls(n, pa.int32()) if equal is None else pa.array(equal, pa.int32()),
        }
        for name, kind in (("tree", pa.int32()), ("order", pa.binary()), ("sketch", pa.binary()), ("label", pa.binary())):
            columns[name] = pa.nulls(n, kind) if rows is None else rows.column(name)
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of the first region of ``tail`` that are no longer in it.
        tail, head_left, gone = None, plan.reach, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if borders and head_left:
                head = batch.slice(0, head_left)
                head_left -= head.num_rows
                yield found(head.column("class"), None, None, head)
            rows = batch if tail is None else pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
            old = 0 if tail is None else tail.num_rows
            n = rows.num_rows
            order = _matrix(rows.column("order"), 4 * plan.depth)
            sketch = _matrix(rows.column("sketch"), coarse + (plan.fine // 2 if fine else 0))
            tree = rows.column("tree").to_numpy()
            label = _matrix(rows.column("label"), 16)
            active = np.zeros(n, bool)
            region = np.zeros(n, np.int64)
            region[1:] = np.cumsum((tree[1:] != tree[:-1]) | (order[1:, :least] != order[:-1, :least]).any(axis=1))
            place = np.arange(n) - np.searchsorted(region, region) + gone * (region == 0)
            for apart in range(1, min(plan.reach, n - 1) + 1):
                later = np.arange(max(old, apart), n)
                later = later[region[later] == region[later - apart]]
                if fine:
                    later = later[place[later] <= plan.reach]
                if not len(later):
                    break
                later = later[(label[later] != label[later - apart]).any(axis=1)]
                equal = zeros[sketch[later, :coarse] ^ sketch[later - apart, :coarse]].sum(axis=1, dtype=np.int32)
                close = equal >= plan.least_equal
                later, equal = later[close], equal[close]
                if fine and len(later):
                    more = zeros[sketch[later, coarse:] ^ sketch[later - apart, coarse:]].sum(axis=1, dtype=np.int32)
                    close = equal + more >= least_all
                    later, equal = later[close], equal[close]
                if apart <= emit and len(later):
                    one = rows.column("class").take(pa.array(later))
                    other = rows.column("class").take(pa.array(later - apart))
                    swap = pa.compute.less(other, one)
                    yield found(pa.compute.if_else(swap, other, one), pa.compute.if_else(swap, one, other), equal)
                elif len(later):
                    active[later] = True
                    active[later - apart] = True
            if active.any():
                yield found(rows.column("class").filter(pa.array(active)), None, None)
            first = max(0, n - plan.reach)
            gone = int(place[first])
            tail = rows.slice(first)
        if borders and tail is not None:
            yield found(tail.column("class"), None, None, tail)

    import pyarrow.compute  # noqa: F401  (loaded before the function travels)

    return run


def neighbours(classes: DataFrame, plan: NearDedupPlan, emit: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, equal), and every class that has a candidate within reach."""
    fine = "fine" in classes.columns
    sorted_ = forest(classes, plan).repartitionByRange("tree", "order", "class").sortWithinPartitions("tree", "order", "class")
    found = stash(sorted_.mapInArrow(_neighbours(plan, emit, True, fine), _FOUND), "forest-neighbours")
    # At most twice the reach for each range: one task sorts them.
    borders = found.filter("tree is not null").select("tree", "order", F.col("a").alias("class"), "sketch", "label").distinct()
    ordered = borders.repartition(1).sortWithinPartitions("tree", "order", "class")
    across = ordered.mapInArrow(_neighbours(plan, emit, False, fine), _FOUND)
    both = found.filter("tree is null").unionByName(across).select("a", "b", "equal")
    pairs = stash(both.groupBy("a", "b").agg(F.max("equal").alias("equal")), "forest-pairs")
    active = pairs.select(F.col("a").alias("class")).union(pairs.filter("b is not null").select("b")).distinct()
    return pairs.filter("b is not null"), active


def full_sets(rows: DataFrame, plan: NearDedupPlan) -> DataFrame:
    """(class, shingles, fine) of each row of ``class`` and ``text``; ``fine`` is a sketch of further values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _seeds(plan.seed + 1, plan.fine)
        for batch in slices(batches):
            sets = shingle_sets(words_of(_binary(batch.column("text")), SOLID), plan.shingle)
            yield pa.RecordBatch.from_pydict(
                {
                    "class": batch.column("class"),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    "fine": pa.array([_sketch(signature(s, seeds)).tobytes() for s in sets], pa.binary()),
                }
            )

    return rows.select("class", "text").mapInArrow(run, "class binary, shingles array<bigint>, fine binary")


def confirmed(pairs: DataFrame, sets: DataFrame, plan: NearDedupPlan) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    size_a, size_b = F.size("set_a").cast("bigint"), F.size("set_b").cast("bigint")
    bound = F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * plan.percent
    common = F.when(bound, F.size(F.array_intersect("set_a", "set_b"))).cast("bigint")
    return (
        pairs.select("a", "b")
        .join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b")), "b")
        .select("a", "b", (size_a + size_b).alias("both"), common.alias("common"))
        .filter(F.col("common") * 100 >= (F.col("both") - F.col("common")) * plan.percent)
        .select("a", "b")
    )


def crowded(classes: DataFrame, plan: NearDedupPlan) -> DataFrame:
    """(tree, start, class, label) of the regions with more rows than ``reach`` compares and with different labels."""
    start = F.substring(F.col("order"), 1, 4 * plan.least_depth).alias("start")
    rows = forest(classes, plan).select("tree", start, "class", "label")
    sizes = rows.groupBy("tree", "start").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    return rows.join(sizes.filter((F.col("n") > plan.reach + 1) & (F.col("low") != F.col("high"))).select("tree", "start"), ["tree", "start"])


def _linked(plan: NearDedupPlan):
    """A function over the rows of two blocks (or of one): links that join their labels, by full sets.

    Rows are taken by size, each with the larger ones that the bound allows. Pairs that earlier links join are
    left out, and with two blocks the pairs inside one, which meet in the group of that block alone.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        two = key[2].as_py() != key[3].as_py()
        shingles = table.column("shingles").combine_chunks()
        sizes = shingles.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        by_size = np.argsort(sizes, kind="stable")
        table = table.select(["class", "label", "block"]).take(pa.array(by_size))
        ids = np.unique(shingles.take(pa.array(by_size)).flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
        sizes = sizes[by_size]
        ends = np.cumsum(sizes)
        label = np.unique(_matrix(table.column("label").combine_chunks(), 16), axis=0, return_inverse=True)[1].reshape(-1)
        block = table.column("block").to_numpy()
        tops = np.searchsorted(sizes, sizes * 100 // plan.percent, "right")
        mark = np.zeros(len(ids) and ids.max() + 1, np.int32)
        one, other = [], []
        for x, top in enumerate(tops):
            fits = label[x + 1 : top] != label[x]
            if two:
                fits &= block[x + 1 : top] != block[x]
            later = x + 1 + np.flatnonzero(fits)
            if not len(later):
                continue
            mine = ids[ends[x] - sizes[x] : ends[x]]
            mark[mine] = 1
            starts = np.cumsum(sizes[later]) - sizes[later]
            if len(later) == top - x - 1:
                theirs = ids[ends[x] : ends[top - 1]]
            else:
                theirs = ids[np.repeat(ends[later] - sizes[later] - starts, sizes[later]) + np.arange(sizes[later].sum())]
            common = np.add.reduceat(mark[theirs], starts).astype(np.int64)
            mark[mine] = 0
            for y in later[common * 100 >= (sizes[x] + sizes[later] - common) * plan.percent]:
                if label[y] != label[x]:
                    label[label == label[y]] = label[x]
                    one.append(x)
                    other.append(y)
        names = table.column("class")
        return pa.table({"a": names.take(pa.array(one, pa.int64())), "b": names.take(pa.array(other, pa.int64()))})

    return run


def crowded_links(regions: DataFrame, sets: DataFrame, plan: NearDedupPlan) -> DataFrame:
    """Links (a, b) that join all labels which links inside one of the ``regions`` join: no pair is left out."""
    held = regions.join(sets.select("class", "shingles"), "class")
    weights = regions.join(sets.select("class", (F.size("shingles") * F.lit(8)).cast("bigint").alias("bytes")), "class")
    blocks = F.greatest(F.ceil(F.count("*") / plan.block_rows), F.ceil(F.sum("bytes") / plan.block_bytes)).cast("int")
    cuts = weights.groupBy("tree", "start").agg(blocks.alias("blocks"))
    dealt = held.join(cuts, ["tree", "start"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "tree", "start", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "class", "label", "shingles"
    )
    return pairs.groupBy("tree", "start", "i", "j").applyInArrow(_linked(plan), "a binary, b binary").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(class, label) for each end of the edges (a, b): the least class of its component.

    Each round lets every vertex and its parent hook to the least grandparent among the neighbours, and
    halves the paths to the roots; rounds end when no parent changes.
    """
    both = stash(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "component-edges")
    first = both.groupBy(F.col("a").alias("class")).agg(F.min("b").alias("least"))
    state = stash(first.select("class", F.least("class", "least").alias("parent")), "component-state")
    while True:
        grand = state.select(F.col("class").alias("parent"), F.col("parent").alias("grand"))
        lifted = stash(state.join(grand, "parent").select("class", "parent", "grand"), "component-grand")
        near = both.join(lifted.select(F.col("class").alias("b"), "grand"), "b").groupBy("a").agg(F.min("grand").alias("least"))
        hooked = near.select(F.col("a").alias("class"), "least").join(lifted, "class")
        offers = hooked.select("class", "least").union(hooked.select("parent", "least")).union(lifted.select("class", "grand"))
        best = offers.groupBy("class").agg(F.min("least").alias("least"))
        fresh = state.join(best, "class").select("class", F.least("parent", "least").alias("parent"), F.col("parent").alias("old"))
        fresh = stash(fresh, "component-state")
        done = fresh.filter("parent <> old").isEmpty()
        state = fresh.select("class", "parent")
        if done:
            return state.select("class", F.col("parent").alias("label"))


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose classes have different labels, with the labels."""
    return (
        pairs.join(labels.select(F.col("class").alias("a"), F.col("label").alias("label_a")), "a")
        .join(labels.select(F.col("class").alias("b"), F.col("label").alias("label_b")), "b")
        .filter("label_a <> label_b")
    )


def _best(pairs: DataFrame) -> DataFrame:
    """For each class the pair with the most equal values."""
    ends = pairs.select("a", "b", "equal", F.explode(F.array("a", "b")).alias("end"))
    best = ends.groupBy("end").agg(F.max(F.struct("equal", "a", "b")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after joining components by links (a, b)."""
    joined = _between(links, labels).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    moved = components(joined).select(F.col("class").alias("label"), F.col("label").alias("to"))
    return stash(labels.join(moved, "label", "left").select("class", F.coalesce("to", "label").alias("label")), "component-labels")


def near_duplicates(
    docs: DataFrame, plan: NearDedupPlan = NearDedupPlan(), *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For each row: its id, ``key`` (of the row), ``n_shingles``, ``component_id`` and ``kept``.

    Words end at blanks and control characters; A-Z is lower-cased. A text with fewer words than a shingle
    is one shingle; null, empty and blank texts have none, are linked with nothing and stand alone. Rows
    with equal sets are linked. ``component_id`` is the least id of the component; rows without an id
    never give it, but belong to components; in a component without any id it is null, and the rows of the least
    ``key`` are kept. Rows that repeat get equal results; an empty table gives an empty one. Only the two
    columns named are read.
    """
    rows = docs.select(F.col(id_column).alias("id"), row_key(id_column, text).alias("key"), F.col(text).alias("text"))
    signed = stash(signatures(rows, plan), "signatures")
    classes = stash(
        signed.filter("class is not null").groupBy("class").agg(
            F.min("id").alias("id"), F.min("key").alias("key"), F.any_value("signature").alias("signature")
        ),
        "set-classes",
    )
    pairs, active = neighbours(classes.select("class", "signature", F.col("class").alias("label")), plan, plan.close)
    # The neighbours of a class in a long region may all differ while one beyond them is a link.
    crowds = crowded(classes.select("class", "signature", F.col("class").alias("label")), plan).select("class")
    chosen = stash(classes.join(active.union(crowds).distinct(), "class").select("class", "key", "signature"), "near-classes")
    members = rows.join(chosen.select("class", "key"), "key").dropDuplicates(["class"])
    sets = stash(full_sets(members, plan), "full-sets")

    labels = chosen.select("class", F.col("class").alias("label"))
    labels = _merged(labels, stash(confirmed(_best(pairs), sets, plan), "links"))
    labels = _merged(labels, stash(confirmed(_between(pairs, labels), sets, plan), "links"))
    fine = sets.select("class", "fine")
    further, _ = neighbours(chosen.join(labels, "class").join(fine, "class"), plan, plan.reach)
    labels = _merged(labels, stash(confirmed(further, sets, plan), "links"))
    regions = stash(crowded(chosen.join(labels, "class"), plan), "long-regions")
    labels = _merged(labels, stash(crowded_links(regions, sets, plan), "links"))

    labelled = classes.select("class", "id", "key").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = labelled.groupBy("label").agg(F.min("id").alias("component_id"), F.min("key").alias("first_key"))
    named = labelled.select("class", "label").join(least, "label").select("class", "component_id", "first_key")
    first = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull() & (F.col("key") == F.col("first_key")))
    linked = signed.filter("class is not null").join(named, "class").select("id", "key", "n_shingles", "component_id", first.alias("kept"))
    # Rows without words have no class to be joined on.
    alone = signed.filter("class is null").select("id", "key", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(alone).withColumnRenamed("id", id_column)


def keep_one_of_each(docs: DataFrame, plan: NearDedupPlan = NearDedupPlan(), *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, in the columns of ``docs``; rows that repeat it stay once."""
    kept = near_duplicates(docs, plan, id_column=id_column, text=text).filter("kept").select(F.col("key").alias("_key"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), row_key(id_column, text).alias("_key"))
    return rows.join(kept.distinct(), "_key").dropDuplicates(["_key"]).select("_row.*")
