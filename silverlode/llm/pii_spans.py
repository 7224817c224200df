"""Personal data in texts: plain patterns, and the same patterns behind disguises.

A transducer rewrites disguises (look-alike letters and digits, invisible characters, spelled digits,
"at" and "dot") and records for every run of output the run of source it came from. Identifiers are
then looked for in the rewritten text and mapped back to the source characters they cover.

One Arrow UDF over the text: rows are judged alone, nothing is exchanged.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"

# Kinds and patterns of the contract, in its order.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones, each above the letter it stands for.
_LOOKS = "аеорсухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅαονρικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
_LIKE = "aeopcyxijsdhqwABEKMHOPCTYXIJSaovpikABEZHIKMNOPTYX"
LOOKALIKES = dict(zip(_LOOKS, _LIKE, strict=True))
INVISIBLE = "­​‌‍⁠﻿"
DIGITS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")

_DIGIT_WORD = "|".join(DIGITS)
#: Four spelled digits or more in a row, a spelled plus included.
_SPELLED = re.compile(rf"(?i)\b(?:plus[ -]+)?(?:{_DIGIT_WORD})(?:(?:[ -]{{1,2}}|, )(?:{_DIGIT_WORD})){{3,}}\b")
_SPELLED_PART = re.compile(rf"(?i)(?P<word>{_DIGIT_WORD})|(?P<plus>plus[ -]+)|(?P<gap>[ ,-]+)")
_SPELLED_HINT = re.compile(rf"(?:{_DIGIT_WORD})[ ,-]{{1,2}}(?:{_DIGIT_WORD})[ ,-]")
#: Both start at the first of their blanks, so that a long row of blanks is looked at once.
_AT = re.compile(r"(?i)(?<! )[ ]*+(?:\[ *(?:at|@) *\]|\( *(?:at|@) *\)|\{ *(?:at|@) *\}|< *(?:at|@) *>)[ ]*")
_DOT = re.compile(r"(?i)(?<! )[ ]*+(?:\[ *(?:dot|\.) *\]|\( *(?:dot|\.) *\)|\{ *(?:dot|\.) *\}|< *(?:dot|\.) *>)[ ]*")
#: "name at host dot com" and "name@host dot com", without brackets.
_WORDED = re.compile(
    r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?P<at> +at +|@)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
    r"(?P<rest>(?: +dot +[A-Za-z0-9-]+)+)(?![A-Za-z0-9-])"
)
_WORDED_DOT = re.compile(r"(?i)(?<! ) +dot +")
#: "name at host.com": the last part of the host has letters only.
_WORDED_AT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?P<at> +(?i:at) +)(?=(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9-]))"
)
#: "10 dot 0 dot 0 dot 1".
_NUMBER_DOT = re.compile(r"(?i)(?<=[0-9]) +dot +(?=[0-9])")
#: In lower case, every text that one of the five patterns above rewrites matches this.
_SIGN_HINT = re.compile(r"[\[({<] *(?:at|@|dot|\.) *[\])}>]| dot | at +[a-z0-9-]+\.[a-z0-9-]")
#: Characters that may be look-alikes: other scripts, full-width forms, invisible ones, styled letters and digits.
_STRANGE = re.compile(f"[{INVISIBLE}Ͱ-ԯ٠-٩۰-۹०-९․！-～\U0001d400-\U0001d7ff]")


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: ``IP`` from the first digit of a number: what fails there fails at its other digits, too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The spans of ``EMAIL.finditer`` in linear time: each at sign is extended to both sides.

    What stands before an at sign and fails is never looked at again, as the next one lies beyond it.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at)
        start = at
        while host and start > free and text[start - 1] in _LOCAL:
            start -= 1
        if host and start < at:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def find(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of plain identifiers, by kind and then place; no retries after a failing match."""
    for start, end in emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        # Compared as texts first: a part may have more digits than a number should.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()


def plain_character(char: str) -> str:
    """What a strange character stands for: itself if nothing is known."""
    if char in INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    if char == "․":
        return "."
    digit = unicodedata.decimal(char, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", char)
    return folded if folded.isascii() and len(folded) == 1 else char


class Traced:
    """A rewritten text that knows, for each character, the source span it came from and whether it changed."""

    def __init__(self, text: str):
        self.text = text
        self.starts = array("q", range(len(text)))
        self.ends = array("q", range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Put ``new`` for the characters from ``start`` to before ``end``, for each change from left to right.

        Every new character stands for the whole span that it replaces. What is removed joins the
        character before it, so that spans stay without holes.
        """
        if not changes:
            return
        text, starts, ends, changed = [], array("q"), array("q"), bytearray()
        at = 0
        for start, end, new in changes:
            text += [self.text[at:start], new]
            starts += self.starts[at:start] + array("q", [self.starts[start]]) * len(new)
            ends += self.ends[at:start] + array("q", [self.ends[end - 1]]) * len(new)
            changed += self.changed[at:start] + b"\x01" * len(new)
            if not new and changed:
                changed[-1] = 1
                ends[-1] = self.ends[end - 1]
            at = end
        self.text = "".join(text) + self.text[at:]
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]
        self.changed = changed + self.changed[at:]

    def replace(self, pattern: re.Pattern[str], new: Callable[[re.Match[str]], list[tuple[int, int, str]]]) -> None:
        self.rewrite([change for m in pattern.finditer(self.text) for change in new(m)])


def _spelled(m: re.Match[str]) -> list[tuple[int, int, str]]:
    """A run of spelled digits becomes one number without gaps."""
    changes = []
    for part in _SPELLED_PART.finditer(m[0]):
        new = "+" if part["plus"] else "" if part["gap"] else str(DIGITS.index(part["word"].lower()))
        changes.append((m.start() + part.start(), m.start() + part.end(), new))
    return changes


def _worded(m: re.Match[str]) -> list[tuple[int, int, str]]:
    dots = [(m.start("rest") + d.start(), m.start("rest") + d.end(), ".") for d in _WORDED_DOT.finditer(m["rest"])]
    return [(m.start("at"), m.end("at"), "@"), *dots]


def disguised(text: str) -> list[tuple[str, int, int]]:
    """Identifiers that only show after rewriting: (kind, start, end) in the source text."""
    strange = not text.isascii() and _STRANGE.search(text)
    lower = text.lower()
    dotted = _SIGN_HINT.search(lower)
    spelled = _SPELLED_HINT.search(lower)
    if not (strange or dotted or spelled):
        return []
    traced = Traced(text)
    if strange:
        traced.replace(_STRANGE, lambda m: [(m.start(), m.end(), plain_character(m[0]))] if plain_character(m[0]) != m[0] else [])
    traced.replace(_SPELLED, _spelled)
    traced.replace(_AT, lambda m: [(m.start(), m.end(), "@")])
    traced.replace(_DOT, lambda m: [(m.start(), m.end(), ".")])
    traced.replace(_WORDED, _worded)
    traced.replace(_WORDED_AT, lambda m: [(m.start("at"), m.end("at"), "@")])
    traced.replace(_NUMBER_DOT, lambda m: [(m.start(), m.end(), ".")])
    if not any(traced.changed):
        return []
    return [
        (kind, traced.starts[start], traced.ends[end - 1])
        for kind, start, end in find(traced.text)
        if any(traced.changed[start:end])
    ]


def spans_of(text: str | None) -> list[dict]:
    """All spans of a text, by kind and place; base spans stay and disguised ones are added."""
    if not text:
        return []
    base = list(find(text))
    held = set(base)
    more = [span for span in dict.fromkeys(disguised(text)) if span not in held]
    found = [(KINDS.index(k), s, e, True) for k, s, e in base] + [(KINDS.index(k), s, e, False) for k, s, e in more]
    return [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in sorted(found)]


def pii_spans(text: Column) -> Column:
    """An array of (kind, start, end, base), by kind and place; code points, end exclusive."""

    @F.arrow_udf(SPANS_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([spans_of(t.as_py()) for t in texts], pa.list_(SPAN))

    return spans(text)


def find_pii(docs: DataFrame, *, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with the array ``out`` of spans of personal data.

    Null and empty texts have none; rows that repeat get equal spans; an empty table gives an empty one.
    ``out`` replaces a column of that name, other columns may have any name.
    """
    return docs.withColumn(out, pii_spans(F.col(text)))


def join_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def findings(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""

    def base(kind: str | None = None) -> Column:
        return F.filter("spans", lambda s: s["base"] if kind is None else s["base"] & (s["kind"] == kind))

    return found.select(
        id_column,
        *(F.size(base(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(join_spans(base()), 256).alias("base_sha256"),
        join_spans(F.col("spans")).alias("spans"),
    )
