"""Packing of tokenised documents into fixed-length sequences by first-fit decreasing.

Documents are dealt at random into groups of a few megabytes of text; each group is tokenised and
packed by itself, so one group is all that a task holds at a time and a lost executor costs only the
groups it had. Within a group every full sequence of a long document stands alone; what remains of each
document is placed whole, largest first, into the first bin with room, found in a tournament tree over
the bins' free capacities.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PackingPlan:
    tokenizer: str
    length: int = 4096
    end_id: int = 2
    #: Text bytes per group, on average.
    group_bytes: int = 4 << 20
    seed: int = 17
    #: Distinct words whose ids a worker remembers; it starts anew when there are more.
    cached_words: int = 400_000


# The tokenizer settings under which words may be encoded one by one.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class WordEncoder:
    """Token ids of whole texts, with the ids of every word looked up once.

    For tokenizers that normalise as above, drop white space and start anew at every change between letters and
    other characters (apostrophes aside); with any other tokenizer every text goes to it whole. So do texts for
    which word-wise encoding could differ: separators that only Python counts as white space, special
    tokens written out, characters on which two versions of Unicode may differ, and texts whose lower case is not in the composed form (as its parts would then be
    normalised a second time). Texts are normalised before they are split, as the tokenizer does.
    """

    _WHOLE = re.compile("[\x1c-\x1f]|<\\|")
    #: Anything but scripts and signs whose letters, digits and cases have long been settled: Latin, Greek, Cyrillic,
    #: punctuation, currency and letter-like signs, arrows to dingbats, kana, ideographs, Hangul, full-width forms, emoji.
    _UNSETTLED = re.compile(
        "[^\\u0000-\\u052f\\u1e00-\\u206f\\u20a0-\\u20bf\\u2100-\\u218b\\u2190-\\u27bf\\u3000-\\u3029\\u3041-\\u30ff"
        "\\u4e00-\\u9fa5\\uac00-\\ud7a3\\ufe0f\\uff01-\\uffee\\U0001f300-\\U0001f6ff\\U0001f900-\\U0001f9ff]"
    )
    _UNITS = re.compile(r"[^\W\d_]+|[\W\d_]+")

    def __init__(self, path: str, cached_words: int):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.by_word = (
            settings.get("normalizer") == _NORMALIZER
            and settings.get("pre_tokenizer") == _PRE_TOKENIZER
            and settings["model"]["type"] == "BPE"
            and all(t["content"].startswith("<|") for t in settings.get("added_tokens", ()))
        )
        self._limit = cached_words
        self._words: dict[str, bytes] = {}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(printable)]
        # Byte-level vocabularies write a byte as itself if it prints, else as the next code point from 256 on.
        self._bytes = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(hidden)}

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _normal(self, text: str) -> str | None:
        """The text as the tokenizer normalises it, white space aside; None if normalising once more changes it."""
        if text.isascii():
            return text.lower()
        if self._UNSETTLED.search(text):
            return None
        # Python lower-cases a final capital sigma by its place, the tokenizer does not.
        if "\u03a3" not in text and unicodedata.is_normalized("NFC", text):
            plain = text.lower()
        else:
            plain = self._tokenizer.normalizer.normalize_str(text)
        return plain if unicodedata.is_normalized("NFC", plain) else None

    def _unit(self, unit: str) -> bytes:
        if not unit.isalpha():
            return self._whole(unit)
        plain = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self._bytes)
        return np.array([t.id for t in self._tokenizer.model.tokenize(plain)], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if "'" in word:
            ids = self._whole(word)
        else:
            ids = b""
            for unit in self._UNITS.findall(word):
                known = self._words.get(unit)
                if known is None:
                    known = self._unit(unit)
                    self._words[unit] = known
                ids += known
        if len(self._words) >= self._limit:
            self._words.clear()
        self._words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        plain = self._normal(text) if self.by_word and not self._WHOLE.search(text) else None
        if plain is None:
            return self._whole(text)
        words = plain.split()
        ids = list(map(self._words.get, words))
        if None in ids:
            ids = [self._word(w) if known is None else known for w, known in zip(words, ids, strict=True)]
        return b"".join(ids)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, cached_words: int) -> WordEncoder:
    """One encoder for each worker process."""
    key = (path, cached_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, cached_words)
    return _ENCODERS[key]


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every item; ties go by position.

    ``tree[1]`` is the largest free capacity of all bins, ``tree[2 n]`` and ``tree[2 n + 1]`` those of the
    halves below ``n``; leaves are the bins from left to right, as many as items.
    """
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, node = sizes[item], 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        placed[item] = (node - leaves, capacity - tree[node])
        tree[node] -= size
        while node > 1:
            node //= 2
            largest = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == largest:
                break
            tree[node] = largest
    return placed


def pack_group(ids: Iterable[bytes], length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, bin, offset) of each piece of the documents given by their ids."""
    sizes = [len(x) // 4 for x in ids]
    full = 0
    rest = []
    for doc, size in enumerate(sizes):
        whole = size - size % length
        for start in range(0, whole, length):
            yield doc, start, length, full, 0
            full += 1
        if size > whole:
            rest.append((doc, whole, size - whole))
    for (doc, start, size), (number, offset) in zip(rest, first_fit_decreasing([r[2] for r in rest], length), strict=True):
        yield doc, start, size, full + number, offset


def pack(docs: DataFrame, plan: PackingPlan, *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its ids and its place.

    Columns: ``id_column``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit numbers),
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset``. Null and empty texts are the end id
    alone. Rows that repeat are packed as often as they occur; an empty table gives no pieces. Other
    columns are not read. Sequence ids are unique: group number times 2^31, plus the number in the group.
    """
    total = docs.agg(F.sum(F.octet_length(text)), F.count("*")).first()
    n_groups = 1 + ((total[0] or 0) + total[1]) // plan.group_bytes
    group = F.pmod(F.xxhash64(F.col(id_column), F.col(text), F.lit(plan.seed)), F.lit(n_groups))
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(table: pa.Table) -> pa.Table:
        encode = encoder(plan.tokenizer, plan.cached_words).encode
        end = np.array([plan.end_id], "<u4").tobytes()
        ids = [(encode(t) if t else b"") + end for t in table.column("text").to_pylist()]
        first = table.column("group")[0].as_py() << 31
        pieces = list(pack_group(ids, plan.length))
        doc, start, size, number, offset = (np.array(x, "i8") for x in zip(*pieces, strict=True))
        return pa.table(
            {
                id_column: table.column("id").take(pa.array(doc)),
                "start": start,
                "length": size,
                "ids": pa.array([ids[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in pieces], pa.binary()),
                "doc_tokens": np.array([len(x) // 4 for x in ids], "i8")[doc],
                "sequence_id": number + first,
                "offset": offset,
            }
        )

    rows = docs.select(group.alias("group"), F.col(id_column).alias("id"), F.col(text).alias("text"))
    return rows.groupBy("group").applyInArrow(run, schema)


def piece_digests(pieces: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    return pieces.select(
        id_column, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
