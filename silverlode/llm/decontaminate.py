"""Benchmark passages in documents: a set join that starts from each passage's rarest shingle.

An item is cut into windows (an item shorter than a window is one). A document holds a window only if it
holds all its shingles, so the rarest one, counted over the documents, is prefix enough for the join.
A Bloom filter of these shingles, bounded in size, lets tasks send only places that may match. Their
length and the shingle's place in the window bound what can match; the words decide exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm import bloom
from silverlode.llm.common import row_key, slices
from silverlode.llm.wordhash import ALNUM, Words, runs, words_of
from silverlode.session import stash


@dataclass(frozen=True)
class DecontaminationPlan:
    #: Words of an item that must occur in a row.
    window: int = 10
    shingle: int = 5
    #: Bound of the filter of prefix shingles in bits: 16 MB. Beyond, more places are sent than match.
    max_cells: int = 1 << 27

    def shingle_of(self, length: int) -> int:
        return min(self.shingle, length)


def _binary(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _spoken(words: Words, first: int, last: int) -> list[str]:
    """The words from ``first`` to before ``last``."""
    return [words.data[s:e].decode() for s, e in zip(words.start[first:last], words.end[first:last], strict=True)]


def windows_of(items: DataFrame, plan: DecontaminationPlan) -> DataFrame:
    """(item, window) for each different window of each item, as arrays of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(_binary(batch.column("text")), ALNUM)
            rows, windows, at = [], [], 0
            for n, count in enumerate(words.counts):
                own = _spoken(words, at, at + count)
                at += count
                size = min(plan.window, len(own))
                found = dict.fromkeys(tuple(own[i : i + size]) for i in range(len(own) - size + 1)) if size else {}
                rows += [n] * len(found)
                windows += map(list, found)
            yield pa.RecordBatch.from_pydict(
                {"item": batch.column("item").take(pa.array(rows, pa.int64())), "window": pa.array(windows, pa.list_(pa.string()))}
            )

    item_type = items.schema["item"].dataType.simpleString()
    return items.mapInArrow(run, f"item {item_type}, window array<string>")


def shingles_of(windows: DataFrame, plan: DecontaminationPlan) -> DataFrame:
    """(window, place, hash) for each shingle of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("window").to_pylist()
            words = words_of([" ".join(w).encode() for w in lists], ALNUM)
            before = np.cumsum(words.counts) - words.counts
            rows, places, hashes = [], [], []
            for size in {plan.shingle_of(len(w)) for w in lists}:
                first, found = runs(words, size)
                text = words.text[first]
                fits = np.array([plan.shingle_of(len(w)) == size for w in lists], bool)[text] if len(first) else text.astype(bool)
                rows.append(text[fits])
                places.append((first - before[text])[fits])
                hashes.append(found[fits])
            if rows:
                row = np.concatenate(rows)
                yield pa.RecordBatch.from_pydict(
                    {
                        "window": batch.column("window").take(pa.array(row)),
                        "place": pa.array(np.concatenate(places), pa.int32()),
                        "hash": pa.array(np.concatenate(hashes).view(np.int64)),
                    }
                )

    return windows.mapInArrow(run, "window array<string>, place int, hash bigint")


def _hashes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)


def _filter_of(shingles: DataFrame, plan: DecontaminationPlan):
    once, _ = bloom.build(shingles.select("hash"), _hashes, bloom.cells_for(2 * shingles.count(), plan.max_cells))
    return shingles.sparkSession.sparkContext.broadcast(once)


def occurrences(docs: DataFrame, shingles: DataFrame, plan: DecontaminationPlan) -> DataFrame:
    """(hash, n) of the shingles that occur in the documents; some others may be among them."""
    held = _filter_of(shingles, plan)
    sizes = sorted({plan.shingle_of(n) for n in range(1, plan.window + 1)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(_binary(batch.column("text")), ALNUM)
            found = [h[bloom.contains(held.value, h)] for h in (runs(words, size)[1] for size in sizes)]
            hashes, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"hash": pa.array(hashes.view(np.int64)), "n": pa.array(counts.astype(np.int64))})

    return docs.select("text").mapInArrow(run, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))


def prefixes(docs: DataFrame, windows: DataFrame, plan: DecontaminationPlan) -> DataFrame:
    """(window, place, hash) of the rarest shingle of each window."""
    shingles = stash(shingles_of(windows.select("window").distinct(), plan), "benchmark-shingles")
    counts = occurrences(docs, shingles, plan)
    ranked = shingles.join(counts, "hash", "left").select("window", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "hash").alias("s"))
    return ranked.groupBy("window").agg(F.min("s").alias("s")).select("window", "s.place", "s.hash")


def places(docs: DataFrame, prefix: DataFrame, plan: DecontaminationPlan) -> DataFrame:
    """(key, n_words, hits) for each document: the places whose shingle may be a prefix, with the words around."""
    held = _filter_of(prefix, plan)
    sizes = sorted({plan.shingle_of(n) for n in range(1, plan.window + 1)})
    hit = pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = words_of(_binary(batch.column("text")), ALNUM)
            begin = np.cumsum(words.counts) - words.counts
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for size in sizes:
                first, hashes = runs(words, size)
                reach = plan.window - size
                for i in np.flatnonzero(bloom.contains(held.value, hashes)):
                    at = int(first[i])
                    text = int(words.text[at])
                    low = max(int(begin[text]), at - reach)
                    high = min(int(begin[text] + words.counts[text]), at + size + reach)
                    spoken = _spoken(words, low, high)
                    signed = int(hashes[i : i + 1].view(np.int64)[0])
                    hits[text].append({"hash": signed, "at": at - int(begin[text]), "before": at - low, "words": spoken})
            yield pa.RecordBatch.from_pydict(
                {"key": batch.column("key"), "n_words": pa.array(words.counts.astype(np.int64)), "hits": pa.array(hits, pa.list_(hit))}
            )

    return docs.select("key", "text").mapInArrow(
        run, "key binary, n_words bigint, hits array<struct<hash:bigint,at:bigint,before:int,words:array<string>>>"
    )


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    plan: DecontaminationPlan = DecontaminationPlan(),
    *,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    out: str = "benchmark",
) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit (words inside any window's occurrence) and the item ids.

    Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased. Null texts have no
    words; items without words occur nowhere; items without an id count as hits but are not listed. Rows
    that repeat get equal results; items that repeat count once by id. Empty tables of either kind give
    documents without hits. ``out`` replaces a column of that name, other columns may have any name.
    """
    keyed = docs.select(row_key(id_column, text).alias("key"), F.col(text).alias("text"))
    windows = stash(windows_of(items.select(F.col(item_column).alias("item"), F.col(item_text).alias("text")), plan), "benchmark-windows")
    prefix = stash(prefixes(keyed, windows, plan), "benchmark-prefixes")
    found = stash(places(keyed, prefix, plan).dropDuplicates(["key"]), "benchmark-places")

    start = F.col("h.at") - F.col("place")
    lead = F.col("h.before") - F.col("place")
    length = F.size("window")
    hits = (
        found.select("key", F.explode("hits").alias("h"))
        .withColumn("hash", F.col("h.hash"))
        .join(prefix, "hash")
        .filter((lead >= 0) & (F.size("h.words") >= lead + length))
        .filter(F.slice("h.words", lead + 1, length) == F.col("window"))
        .select("key", "window", start.alias("start"), (start + length).alias("end"))
    )
    hits = stash(hits, "benchmark-hits")
    # Words that an occurrence adds to those of the occurrences that start before it.
    seen = "max(end) over (partition by key order by start, end rows between unbounded preceding and 1 preceding)"
    cover = (
        hits.select("key", "start", "end")
        .distinct()
        .select("key", F.expr(f"greatest(0, end - greatest(start, coalesce({seen}, 0)))").alias("new"))
        .groupBy("key")
        .agg(F.sum("new").alias("n_hit"))
    )
    named = hits.select("key", "window").distinct().join(windows, "window").groupBy("key").agg(F.collect_set("item").alias("items"))
    results = found.select("key", "n_words").join(cover, "key", "left").join(named, "key", "left")
    results = results.select(
        "key",
        F.struct(
            "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.array_sort(F.coalesce(F.transform("items", lambda i: i.cast("string")), F.array().cast("array<string>"))).alias("items"),
        ).alias("result"),
    )
    kept = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*kept).alias("row"), row_key(id_column, text).alias("key"))
    return rows.join(results, "key").select("row.*", F.col("result").alias(out))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, plan: DecontaminationPlan = DecontaminationPlan(), *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents that hold no benchmark passage, in the columns of ``docs``."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"))
    found = find_passages(rows, items, plan, id_column="id", out="benchmark")
    return found.filter("benchmark.n_hit = 0").select("row.*")
