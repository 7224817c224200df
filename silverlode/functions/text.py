"""Text cleaning. Every helper takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnLike) -> Column:
    """Trimmed text; what is empty after the trim is null."""
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def upper_code(c: ColumnLike) -> Column:
    """Trimmed upper-case code or key; blank is null."""
    return blank_to_null(F.upper(as_column(c)))


def squeeze_spaces(c: ColumnLike) -> Column:
    """Every run of white space becomes one space, ends trimmed, blank is null."""
    return blank_to_null(F.regexp_replace(as_column(c), r"\s+", " "))


def clean_name(c: ColumnLike) -> Column:
    """Product names: dashes read as spaces, then ``squeeze_spaces`` (all matches, not the first)."""
    return squeeze_spaces(F.replace(as_column(c), F.lit("-"), F.lit(" ")))


def drop_prefix(c: ColumnLike, prefix: str) -> Column:
    """Remove a literal prefix at the start of the text only."""
    c = as_column(c)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2147483647)).otherwise(c)


def drop_dashes(c: ColumnLike) -> Column:
    return F.replace(as_column(c), F.lit("-"), F.lit(""))


def split_qualified_key(c: ColumnLike) -> dict[str, Column]:
    """Positional split of a product key such as ``BI-RB-BK-R64Y-48``.

    Characters 1-5 name the category (dashes written as underscores in the category table), the
    sales key starts at character 7.
    """
    c = as_column(c)
    prefix = F.substring(c, 1, 5)
    return {
        "category_key_prefix": prefix,
        "category_id": F.replace(prefix, F.lit("-"), F.lit("_")),
        "product_key": F.nullif(F.substring(c, 7, 2147483647), F.lit("")),
    }


def full_name(*parts: ColumnLike) -> Column:
    """Space-joined parts, nulls skipped; no part at all gives ``''``."""
    return F.concat_ws(" ", *[as_column(p) for p in parts])


def hashed_key(prefix: str, *parts: ColumnLike) -> Column:
    """Stable surrogate key: md5 of ``prefix|part|part``; null when a part is null."""
    pieces: list[Column] = [F.lit(prefix)]
    for part in parts:
        pieces += [F.lit("|"), as_column(part).cast("string")]
    return F.md5(F.concat(*pieces))


def packed_key(c: ColumnLike) -> Column:
    """A ``hashed_key`` in 16 bytes, for counting distinct ones. Any other text becomes longer than that, so
    different texts stay different."""
    c = as_column(c)
    other = F.concat(c, F.lit("|" * 17)).cast("binary")
    return F.when(c.rlike(r"^[0-9a-f]{32}\z"), F.unhex(c)).otherwise(other)


def dashed_key(*parts: ColumnLike) -> Column:
    """Natural key ``a-b``; null when a part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), as_column(part).cast("string")]
    return F.concat(*pieces[1:])
