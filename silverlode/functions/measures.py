"""Money arithmetic and rule-driven labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.functions.text import ColumnLike, as_column


def ratio(numerator: ColumnLike, denominator: ColumnLike, scale: int) -> Column:
    """Quotient rounded half up, exactly, to at most four decimals; null for a null or zero divisor.

    Operands below 10^15 with two decimals divide once: a quotient with 21 decimals is nearer to a rounding
    border than half its last place only if it lies on it, as its divisor has at most 17 digits.
    Larger ones are divided in whole units. That form sits behind a lambda, so it is neither compiled into
    every query nor run where it is not needed.
    """
    if not 0 <= scale <= 4:
        raise ValueError("ratio() rounds to 0 to 4 decimals")
    top, bottom = as_column(numerator), as_column(denominator)
    small_top, small_bottom = top.try_cast("decimal(18,3)"), bottom.try_cast("decimal(17,2)")
    once = F.round(F.try_divide(small_top, small_bottom), scale).cast(f"decimal(38,{scale})")
    large = F.transform(
        F.array(F.struct(_hundredths(top).alias("top"), _hundredths(bottom).alias("bottom"))),
        lambda x: _in_whole_units(x["top"], x["bottom"], scale),
    )
    return F.when(small_top.isNotNull() & small_bottom.isNotNull(), once).when(
        top.isNotNull() & bottom.isNotNull(), large.getItem(0)
    )


def _in_whole_units(top: Column, bottom: Column, scale: int) -> Column:
    """The remainder decides about rounding, and without it the division has no rest."""
    units = (F.abs(top) * 10**scale).cast("decimal(38,0)")
    rest = F.try_mod(units, F.abs(bottom))
    whole = F.try_divide(units - rest, F.abs(bottom)).cast("decimal(36,0)")
    rounded = whole + F.when(rest * 2 >= F.abs(bottom), 1).otherwise(0)
    signed = F.when((top < 0) != (bottom < 0), -rounded).otherwise(rounded)
    return (signed * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def _hundredths(c: Column) -> Column:
    # 28 digits with 2 decimals hold any sum of decimal(18,2) amounts.
    return (c.cast("decimal(28,2)") * 100).cast("decimal(28,0)")


def plain_average(total: ColumnLike, count: ColumnLike) -> Column:
    """Unrounded average as a double; null for no rows."""
    return F.try_divide(as_column(total).cast("double"), as_column(count).cast("double"))


def decode(c: ColumnLike, labels: Mapping[str, str], default: ColumnLike) -> Column:
    """Label of a code from a small fixed mapping, ``default`` for null and unknown codes."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.try_element_at(table, as_column(c)), fallback)


def first_match(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    column = F.when(*rules[0])
    for condition, label in rules[1:]:
        column = column.when(condition, label)
    return column.otherwise(default)


def line_measures(amount: ColumnLike, quantity: ColumnLike, price: ColumnLike) -> dict[str, Column]:
    """Discount against list price, and the price actually realised per unit."""
    amount, quantity, price = as_column(amount), as_column(quantity), as_column(price)
    return {
        "discount_amount": amount - quantity * price,
        "realised_unit_price": F.when(
            (quantity > 0) & (price > 0), ratio(amount, quantity, 2).cast("decimal(18,2)")
        ),
    }


def margin_measures(
    amount: ColumnLike, quantity: ColumnLike, price: ColumnLike, cost: ColumnLike
) -> dict[str, Column]:
    """Margins of a line. Without a cost there is no margin; at cost 0 there is a margin but, by
    contract, no percentage."""
    amount, quantity, price, cost = (as_column(c) for c in (amount, quantity, price, cost))
    margin = amount - quantity * cost
    return {
        "gross_margin": margin,
        "gross_margin_pct": F.when(cost != 0, ratio(margin, amount, 4)),
        "unit_margin_pct": F.when(
            price > 0, F.try_divide((price - cost).cast("double"), price.cast("double"))
        ),
    }
