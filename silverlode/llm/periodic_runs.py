"""Periodic runs of words: stretches that repeat a block three times or more, found without trying periods.

A dictionary of basic factors names every stretch of 1, 2, 4, ... words: equal stretches of a text have
equal names, a name of twice the length comes from two names. Where a stretch occurs again within twice
its length, the occurrences form an arithmetic progression, and its step is proposed as a period. A run
of at least 24 words and three periods is proposed by the least power of two that is 8 or more and no
less than its period: a stretch so long holds a whole period, so inside the run its next occurrence is
one period on. Proposals are extended to both sides by comparing words, each maximal stretch once.

Only places whose stretch occurs again in the same text go on to the next length. In prose few places
are left after four words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import slices, word_blocks


@dataclass(frozen=True)
class RunPlan:
    #: A run has at least so many words, and so many periods (three or more: the proposals rest on it).
    min_words: int = 24
    min_periods: int = 3

    def __post_init__(self):
        if self.min_words < 24 or self.min_periods < 3:
            raise ValueError("shorter runs need shorter basic factors")


def _again(names: np.ndarray, text: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which ``places`` (ascending) have a name that another place of their text has, the distance to the next
    one (0: none), and the names numbered from 0."""
    order = np.argsort(names, kind="stable")
    at, sorted_ = places[order], names[order]
    equal = sorted_[1:] == sorted_[:-1]
    same = equal & (text[at[1:]] == text[at[:-1]])
    distance = np.zeros(len(places), np.int64)
    distance[order[:-1]] = np.where(same, at[1:] - at[:-1], 0)
    repeats = distance > 0
    repeats[order[1:]] |= same
    numbers = np.zeros(len(places), np.int64)
    numbers[order[1:]] = np.cumsum(~equal)
    return repeats, distance, numbers


def proposals(words: np.ndarray, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first place, period) of stretches proposed by the basic factors of each length of 8 words or more.

    ``words`` numbers the words of several texts, one after another, and ``text`` their texts. Neighbouring
    places with one distance are one proposal.
    """
    places, names, length = np.arange(len(words)), words, 1
    while len(places):
        repeats, distance, names = _again(names, text, places)
        if length >= 8:
            near = np.flatnonzero((distance > 0) & (distance <= 2 * length))
            place, period = places[near], distance[near]
            fresh = np.ones(len(near), bool)
            fresh[1:] = (place[1:] != place[:-1] + 1) | (period[1:] != period[:-1])
            yield place[fresh], period[fresh]
        places, names = places[repeats], names[repeats]
        # The two halves of the next length; both must occur again for the whole to do so.
        second = np.minimum(np.searchsorted(places, places + length), len(places) - 1)
        whole = np.flatnonzero((places[second] == places + length) & (text[places[second]] == text[places]))
        names = names[whole] * np.int64(names.max(initial=0) + 1) + names[second[whole]]
        places, length = places[whole], 2 * length


def _equal_ahead(one: np.ndarray, other: np.ndarray) -> int:
    """How many leading elements agree; looks at little more than those."""
    n, at, size = min(len(one), len(other)), 0, 32
    while at < n:
        stop = min(n, at + size)
        differ = np.flatnonzero(one[at:stop] != other[at:stop])
        if len(differ):
            return at + int(differ[0])
        at, size = stop, 2 * size
    return n


def runs_of(words: np.ndarray, text: np.ndarray, plan: RunPlan = RunPlan()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period; see ``proposals`` for the arguments."""
    found = list(proposals(words, text))
    if not found:
        return []
    place, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((place, period))
    bounds = np.searchsorted(text, np.arange(text[-1] + 2))
    runs, last, end = [], 0, 0
    for at, step in zip(place[order].tolist(), period[order].tolist(), strict=True):
        if step == last and at < end:
            continue
        low, high = int(bounds[text[at]]), int(bounds[text[at] + 1])
        start = at - _equal_ahead(words[low:at][::-1], words[low : at + step][::-1])
        # ``end`` is the first place whose word differs from the one a period on.
        last, end = step, at + _equal_ahead(words[at:high], words[at + step : high])
        length = end + step - start
        if length >= max(plan.min_words, plan.min_periods * step):
            runs.append((start, length, step))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, their numbers over all texts (equal words of a text have equal ones), and their texts."""
    known: dict[bytes, int] = {}
    words = [[w for block in word_blocks(t) for w in block] for t in texts]
    fresh = count()
    numbers = [np.fromiter(map(known.setdefault, w, fresh), np.int64, len(w)) for w in words]
    return words, np.concatenate(numbers), np.repeat(np.arange(len(texts)), [len(w) for w in words])


def find_runs(docs: DataFrame, plan: RunPlan = RunPlan(), *, text: str = "text", out: str = "periodic") -> DataFrame:
    """``docs`` with a struct ``out``: ``runs`` (start, length, period; in words) and the ``collapsed`` text.

    Words end at blanks and control characters and are compared as they are. A run is a maximal stretch with its
    least period. ``collapsed`` joins by one blank the words that no run holds after its first period. A null,
    empty or blank text has no runs and collapses to the empty text; rows that repeat are treated alike. ``out``
    replaces a column of that name, other columns may have any name and only ``text`` is read. A task holds
    the words of about two megabytes of text at a time, or of one longer text.
    """

    kept_columns = [c for c in docs.columns if c != out]
    at = "_text" if "_text" not in docs.columns else "_" * (1 + max(map(len, docs.columns)))
    rows = docs.select(*kept_columns, F.col(text).alias(at))
    kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            words, numbers, of = _numbered([t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()])
            starts = np.cumsum([0, *map(len, words)])
            runs: list[list[dict[str, int]]] = [[] for _ in words]
            gone = np.zeros(len(numbers) + 1, np.int64)
            for start, length, period in runs_of(numbers, of, plan) if len(numbers) else []:
                n = int(of[start])
                runs[n].append({"start": start - int(starts[n]), "length": length, "period": period})
                gone[start + period] += 1
                gone[start + length] -= 1
            kept = np.cumsum(gone[:-1]) == 0
            for n, found in enumerate(runs):
                if found:
                    words[n] = [w for w, stays in zip(words[n], kept[starts[n] : starts[n + 1]], strict=True) if stays]
            collapsed = pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string())
            added = pa.StructArray.from_arrays([pa.array(runs, pa.list_(kind)), collapsed], ["runs", "collapsed"])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept_columns), added], [*kept_columns, out])

    added = T.StructField(out, T.StructType.fromDDL("runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"))
    return rows.mapInArrow(run, T.StructType([docs.schema[c] for c in kept_columns] + [added]))
