"""Row rejection with reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def keep_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows on which every rule is true (null counts as broken)."""
    for rule in rules.values():
        df = df.filter(rule)
    return df


def rejected(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The other rows, with the names of all broken rules in ``reasons``."""
    named = [F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*named))).filter(F.size("reasons") > 0)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: together exactly the input rows."""
    return keep_valid(df, rules), rejected(df, rules)


def count_by_reason(rejects: DataFrame) -> DataFrame:
    """Rejected rows per reason; a row with two reasons counts under both."""
    return (
        rejects.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )
