"""Code tables of the cleaned layer and the expressions that apply them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.functions.measures import decode
from silverlode.functions.text import ColumnLike, as_column

# Raw codes and the labels reports use.
MARITAL_STATUS = {"M": "Married", "MARRIED": "Married", "S": "Single", "SINGLE": "Single"}
GENDER = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Standard", "T": "Touring"}
MAINTENANCE = {"Y": True, "YES": True, "N": False, "NO": False}

# Country codes that the geography extract mixes with country names.
COUNTRY = {
    "AR": "Argentina",
    "AT": "Austria",
    "AU": "Australia",
    "BE": "Belgium",
    "CA": "Canada",
    "CH": "Switzerland",
    "CN": "China",
    "CO": "Colombia",
    "DE": "Germany",
    "DK": "Denmark",
    "EG": "Egypt",
    "ES": "Spain",
    "FI": "Finland",
    "FR": "France",
    "GB": "United Kingdom",
    "IE": "Ireland",
    "IN": "India",
    "IR": "Iran",
    "IT": "Italy",
    "JP": "Japan",
    "MX": "Mexico",
    "NL": "Netherlands",
    "NO": "Norway",
    "NZ": "New Zealand",
    "PK": "Pakistan",
    "PL": "Poland",
    "PT": "Portugal",
    "SA": "Saudi Arabia",
    "SE": "Sweden",
    "SG": "Singapore",
    "TR": "Turkey",
    "UK": "United Kingdom",
    "US": "United States",
    "USA": "United States",
    "ZA": "South Africa",
}
UNKNOWN = "Unknown"


def marital_status(code: ColumnLike) -> Column:
    return decode(code, MARITAL_STATUS, UNKNOWN)


def gender(code: ColumnLike) -> Column:
    return decode(code, GENDER, UNKNOWN)


def product_line(code: ColumnLike) -> Column:
    return decode(code, PRODUCT_LINE, "Other")


def country(text: ColumnLike, extra: dict[str, str] | None = None) -> Column:
    """Full country name of a code; other text stays as it is, null is ``Unknown``."""
    text = as_column(text)
    return decode(F.upper(text), COUNTRY | (extra or {}), F.coalesce(text, F.lit(UNKNOWN)))


def preferred_gender(first: ColumnLike, second: ColumnLike) -> Column:
    """The first system's gender unless it is unknown, then the second's."""
    known = F.nullif(as_column(first), F.lit(UNKNOWN))
    return F.coalesce(known, as_column(second), F.lit(UNKNOWN))


def maintenance_flag(code: ColumnLike) -> Column:
    """Yes/no code as a boolean; anything else is false."""
    yes = [k for k, v in MAINTENANCE.items() if v]
    return F.coalesce(as_column(code).isin(yes), F.lit(False))
