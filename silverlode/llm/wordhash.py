"""Words of many texts at once and hashes of runs of them, in numpy over the texts' bytes.

A word is a run of bytes of one class. Its hash is a polynomial over its bytes; with prefix sums one
pass over the bytes gives the hashes of all words. Blocks end between words, so that a very long text
takes no more working memory than many short ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

#: ASCII letters (small), digits and all bytes of other characters; everything else parts words.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Everything but blanks and the control characters 9 to 13.
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False


@dataclass(frozen=True)
class Words:
    """``data`` and, for each word in it, where it starts and ends, its hash and the text it is from."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    #: Words of each text.
    counts: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finisher of a common 64-bit hash)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words_of(texts: list[bytes], is_word: np.ndarray) -> Words:
    """Words of UTF-8 texts with A-Z lower-cased (bytes lower-case these alone)."""
    data = b"\n".join(texts).lower()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1)
    all_bytes = np.frombuffer(data, np.uint8)
    inverse = pow(_BASE, -1, 1 << 64)
    starts_, ends_, hashes = [], [], []
    at, powers, inverses = 0, None, None
    while at < len(data):
        stop = min(len(data), at + BLOCK)
        while stop < len(data) and is_word[all_bytes[stop]]:
            more = np.flatnonzero(~is_word[all_bytes[stop : stop + BLOCK]])
            stop = stop + int(more[0]) if len(more) else min(len(data), stop + BLOCK)
        block = all_bytes[at:stop]
        edges = np.diff(is_word[block].astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if powers is None or len(powers) < len(block):
            powers, inverses = _powers(_BASE, len(block)), _powers(inverse, len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * powers[: len(block)], out=sums[1:])
        raw = (sums[last] - sums[first]) * inverses[first] if len(first) else np.zeros(0, np.uint64)
        hashes.append(mixed(raw ^ ((last - first).astype(np.uint64) << np.uint64(48))))
        starts_.append(first + at)
        ends_.append(last + at)
        at = stop
    start = np.concatenate(starts_) if starts_ else np.zeros(0, np.int64)
    text = np.searchsorted(ends, start, "right")
    return Words(
        data,
        start,
        np.concatenate(ends_) if ends_ else start,
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        text,
        np.bincount(text, minlength=len(texts)) if len(texts) else np.zeros(0, np.int64),
    )


def runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``size`` words that lies in one text."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    total = np.full(len(first), size, np.uint64)
    for k in range(size):
        total = mixed(total * np.uint64(0x9FB21C651E98DF25) + words.hash[first + k])
    return first, total
