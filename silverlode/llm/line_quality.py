"""Line-first quality rules: judge lines, drop the failing ones, reject texts that lose too much.

Everything is one projection over the text column, without exchange and without Python: hot sources
and copies need no care, and each row is judged alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import SPACE_PATTERN, SPACES, WORD_PATTERN, let

#: Phrases of page furniture; a short line that holds one of them is boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "terms of service",
    "terms of use",
)


@dataclass(frozen=True)
class QualityLimits:
    min_words: int = 10
    #: Per cent of words that may lie in repeated windows.
    max_repeat_pct: int = 20
    window: int = 5
    #: A line fails if more than this per cent of its words carry symbols or doubled exclamation marks.
    max_marked_pct: int = 50
    #: A line with two separators or more is navigation if it has fewer words than this for each of them.
    words_per_separator: int = 4
    boilerplate_words: int = 12
    #: Per cent of word characters that the failing lines may take.
    max_lost_pct: int = 50


def words_of(text: Column) -> Column:
    """The words as an array; empty for a null or blank text."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_PATTERN)).otherwise(F.array().cast("array<string>"))


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE_PATTERN, "")).cast("bigint")


def repeated_words(words: Column, window: int) -> Column:
    """Words inside windows that occur twice or more, every occurrence included.

    First hashes tell whether any window repeats. Only then the windows themselves are sorted with
    their places, so that equal ones are neighbours, and their cover is summed.
    """
    steps = range(window)

    def at(array: Column, i: Column) -> list[Column]:
        return [F.get(array, i + k) for k in steps]

    def covered(w: Column, places: Column) -> Column:
        pairs = F.array_sort(
            F.transform(places, lambda i: F.struct(F.concat_ws(" ", *at(w, i)).alias("text"), i.alias("place")))
        )
        repeats = let(
            pairs,
            lambda p: F.array_sort(
                F.filter(
                    F.transform(
                        p,
                        lambda x, k: F.when(
                            (F.get(p, k - 1)["text"] == x["text"]) | (F.get(p, k + 1)["text"] == x["text"]), x["place"]
                        ),
                    ),
                    lambda place: place.isNotNull(),
                )
            ),
        )
        return let(
            repeats,
            lambda r: F.aggregate(
                F.transform(r, lambda place, k: F.least(F.lit(window), F.coalesce(F.get(r, k + 1) - place, F.lit(window)))),
                F.lit(0).cast("bigint"),
                lambda total, n: total + n,
            ),
        )

    def body(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - window)
        hashes = F.transform(places, lambda i: F.xxhash64(*at(w, i)))
        return F.when(
            (F.size(w) > window) & let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h)), covered(w, places)
        ).otherwise(F.lit(0).cast("bigint"))

    return let(words, body)


def has_phrase(text: Column) -> Column:
    """Whether a text holds a phrase of page furniture anywhere: few texts do, and only their lines are searched."""
    return let(F.lower(text), lambda low: reduce(lambda a, b: a | b, (F.contains(low, F.lit(p)) for p in BOILERPLATE)))


def line_fails(line: Column, limits: QualityLimits, furnished: Column) -> Column:
    """Whether a line is marked junk, navigation or boilerplate; blank lines never fail."""
    n_words = F.regexp_count(line, F.lit(WORD_PATTERN))
    # Word by word: one pattern for a whole marked word would be tried anew at each character of a long word.
    marked = F.size(F.filter(words_of(line), lambda word: word.rlike(r"[#*$%&<>]|!!")))
    separators = F.regexp_count(line, F.lit(r"(?:^|[\x20\t])(?:\||»|·|>)(?=[\x20\t]|$)"))
    punctuation = line.rlike(r"[#*$%&<>]|!!") & (marked * 100 > n_words * limits.max_marked_pct)
    navigation = line.rlike(r"[|»·>]") & (separators >= 2) & (n_words < (separators + 1) * limits.words_per_separator)
    phrases = r"(?i)(?:" + "|".join(BOILERPLATE) + ")"
    boilerplate = furnished & line.rlike(phrases) & (n_words <= limits.boilerplate_words)
    return punctuation | navigation | boilerplate


def assess(docs: DataFrame, limits: QualityLimits = QualityLimits(), *, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with a struct ``out``: counts, ``base_failed``, ``clean`` text and ``kept``.

    Null and blank texts have no words and fail the base rules. Rows are judged one by one, so rows that
    repeat get equal results and an empty table gives an empty one. ``out`` replaces a column of that
    name; all working columns are lambda variables, so other columns may have any name.
    ``clean`` is the text without its failing lines (null if the text is null).
    """
    given = F.coalesce(F.col(text), F.lit(""))

    def judged(words: Column) -> Column:
        n_words = F.size(words).cast("bigint")
        lines = F.split(given, "\n", -1)
        worded = F.filter(lines, lambda line: line.rlike(WORD_PATTERN))
        clean = let(has_phrase(given), lambda furnished: F.filter(lines, lambda line: ~line_fails(line, limits, furnished)))
        counts = F.struct(
            n_words.alias("n_words"),
            word_chars(given).alias("word_chars"),
            F.length(F.regexp_replace(given, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            let(worded, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("bigint").alias("n_dup_lines"),
            repeated_words(words, limits.window).alias("n_repeat_words"),
            F.when(F.col(text).isNotNull(), F.array_join(clean, "\n")).alias("clean"),
        )

        def verdict(c: Column) -> Column:
            base_failed = (c["n_words"] < limits.min_words) | (
                c["n_repeat_words"] * 100 > c["n_words"] * limits.max_repeat_pct
            )
            lost = c["word_chars"] - word_chars(F.coalesce(c["clean"], F.lit("")))
            too_much = lost * 100 > c["word_chars"] * limits.max_lost_pct
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean")
            return F.struct(
                *(c[n].alias(n) for n in names),
                lost.alias("lost_chars"),
                base_failed.alias("base_failed"),
                (~base_failed & ~too_much).alias("kept"),
            )

        return let(counts, verdict)

    # As rows of a generator the verdicts are computed once, whatever reads their fields later.
    return docs.select(*(c for c in docs.columns if c != out), F.explode(F.array(let(words_of(given), judged))).alias(out))


def keep_good(docs: DataFrame, limits: QualityLimits = QualityLimits(), *, text: str = "text") -> DataFrame:
    """The kept documents with their failing lines removed, in the columns of ``docs``."""
    judged = assess(docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text")), limits)
    cleaned = judged.filter("quality.kept").select("row.*", F.col("quality.clean").alias("quality"))
    return cleaned.select(*(F.col("quality").alias(c) if c == text else F.col(c) for c in docs.columns))
