"""Data-quality checks: offending rows or counts, a severity, and a report that can stop a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.operators.sequence import number_in_key
from silverlode.operators.versioned import union_all
from silverlode.sources.files import exists


class QualityError(RuntimeError):
    """At least one check of severity ``error`` found violations."""


@dataclass(frozen=True)
class RowCheck:
    """A condition every single row must meet. All row checks of a table share one scan."""

    name: str
    holds: Column
    severity: str = "error"

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.holds, F.lit(False))

    def offending(self, df: DataFrame) -> DataFrame:
        return df.filter(self.broken)


@dataclass(frozen=True)
class UniqueCheck:
    """No two rows share the values of ``columns``.

    ``null_is_value`` counts rows with a null as a group of their own (combination check); without
    it rows with a null are skipped (single-column check).
    """

    name: str
    columns: tuple[str, ...]
    severity: str = "error"
    null_is_value: bool = False

    def offending(self, df: DataFrame) -> DataFrame:
        if not self.null_is_value:
            df = df.dropna(subset=list(self.columns))
        counted = df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("row_count"))
        return counted.filter(F.col("row_count") > 1)


@dataclass(frozen=True)
class QueryCheck:
    """Any other check: a frame that must be empty."""

    name: str
    rows: DataFrame
    severity: str = "error"

    def offending(self, df: DataFrame | None = None) -> DataFrame:
        return self.rows


Check = RowCheck | UniqueCheck | QueryCheck


def not_null(*columns: str, severity: str = "error") -> list[RowCheck]:
    return [RowCheck(f"not_null_{c}", F.col(c).isNotNull(), severity) for c in columns]


def unique(*columns: str, severity: str = "error") -> list[UniqueCheck]:
    """One check per column, nulls ignored."""
    return [UniqueCheck(f"unique_{c}", (c,), severity) for c in columns]


def unique_combination(*columns: str, severity: str = "error") -> UniqueCheck:
    return UniqueCheck("unique_" + "_".join(columns), columns, severity, null_is_value=True)


def accepted(column: str, values: Sequence, severity: str = "error") -> RowCheck:
    """Null is not a value, so it passes; add ``not_null`` to forbid it."""
    c = F.col(column)
    return RowCheck(f"accepted_{column}", c.isNull() | c.isin(list(values)), severity)


def expression(name: str, sql: str, severity: str = "error") -> RowCheck:
    """A SQL condition; a null outcome is a violation."""
    return RowCheck(f"expression_{name}", F.expr(sql), severity)


# --- counting --------------------------------------------------------------------------------------


def count_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """``(check_name, severity, failures)`` of every row check, in one pass over ``df``."""
    counted = df.agg(*[F.count_if(c.broken).alias(c.name) for c in checks])
    severity = F.create_map(*[F.lit(x) for c in checks for x in (c.name, c.severity)])
    long = counted.unpivot([], [c.name for c in checks], "check_name", "failures")
    return long.select("check_name", severity[F.col("check_name")].alias("severity"), "failures")


def count_offending(df: DataFrame | None, check: Check) -> DataFrame:
    return check.offending(df).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"), "failures"
    )


def count_violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table: one scan for the row checks, one aggregate per grouped check."""
    by_row = [c for c in checks if isinstance(c, RowCheck)]
    frames = [count_row_checks(df, by_row)] if by_row else []
    frames += [count_offending(df, c) for c in checks if not isinstance(c, RowCheck)]
    return union_all(frames)


def run_checks(
    tables: Mapping[str, tuple[DataFrame, Sequence[Check]]],
    store: str | None = None,
    stop_on_error: bool = True,
) -> list[dict]:
    """Run the checks of several tables in one job; store the offending rows of those that fail.

    A check that passes again empties the rows that it stored before. Returns one record per check with status ``pass``, ``warn`` or ``error``. With
    ``stop_on_error`` an ``error`` raises after everything has been recorded.
    """
    report = union_all(
        [
            count_violations(df, checks).withColumn("table_name", F.lit(name))
            for name, (df, checks) in tables.items()
        ]
    )
    records = []
    for row in report.collect():  # one row per check
        status = "pass" if row["failures"] == 0 else row["severity"]
        records.append(row.asDict() | {"status": status})
    if store:
        failed = {(r["table_name"], r["check_name"]) for r in records if r["status"] != "pass"}
        for name, (df, checks) in tables.items():
            for check in checks:
                path = f"{store.rstrip('/')}/{name}__{check.name}"
                if (name, check.name) in failed:
                    check.offending(df).write.mode("overwrite").parquet(path)
                elif exists(report.sparkSession, path):
                    # What an earlier run left no longer holds.
                    check.offending(df).limit(0).write.mode("overwrite").parquet(path)
    errors = [f"{r['table_name']}.{r['check_name']}: {r['failures']}" for r in records if r["status"] == "error"]
    if errors and stop_on_error:
        raise QualityError("; ".join(errors))
    return records


# --- checks with their own shape -------------------------------------------------------------------


def freshness(
    df: DataFrame, loaded_at: str, now: dt.datetime | None, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest row in hours and its status; an empty table is an ``error``."""
    moment = F.current_timestamp() if now is None else F.lit(now.isoformat(sep=" "))
    moment = moment.cast(df.schema[loaded_at].dataType)
    newest = df.agg(F.max(loaded_at).alias("newest_at"))
    # Microseconds apart, so that 24 hours and one second already count as late.
    age = F.timestamp_diff("MICROSECOND", F.col("newest_at"), moment) / 3_600_000_000
    return newest.withColumn("age_hours", age).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass"),
    )


def reconcile(
    fact: DataFrame, source: DataFrame, key: str, amount: str, units: str
) -> DataFrame:
    """Fact against its source: rows, distinct keys, revenue and units side by side, one row.

    Both sides are tagged, stacked and aggregated together, so there is nothing to join.
    """
    left = fact.select(F.lit(True).alias("in_fact"), F.col(key).alias("k"), amount, units)
    right = source.select(F.lit(False).alias("in_fact"), F.lit(None).cast("string").alias("k"), amount, units)
    in_fact, in_source = F.col("in_fact"), ~F.col("in_fact")
    return left.unionByName(right).agg(
        F.count_if(in_fact).alias("fact_row_count"),
        F.count_if(in_source).alias("expected_row_count"),
        F.countDistinct("k").alias("distinct_line_count"),
        F.sum(F.when(in_fact, F.col(amount))).alias("fact_revenue"),
        F.sum(F.when(in_source, F.col(amount))).alias("expected_revenue"),
        F.sum(F.when(in_fact, F.col(units))).alias("fact_units"),
        F.sum(F.when(in_source, F.col(units))).alias("expected_units"),
    )


def reconcile_breaks(reconciled: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """The reconciliation row if anything differs, else nothing."""
    revenue_gap = F.coalesce("fact_revenue", F.lit(0)) - F.coalesce("expected_revenue", F.lit(0))
    return reconciled.filter(
        (F.col("fact_row_count") != F.col("expected_row_count"))
        | (F.col("distinct_line_count") != F.col("expected_row_count"))
        | (F.abs(revenue_gap) > F.lit(tolerance).cast("decimal(18,2)"))
        | (F.coalesce("fact_units", F.lit(0)) != F.coalesce("expected_units", F.lit(0)))
    )


def violations(counted: DataFrame) -> DataFrame:
    """One-row frame of named counters as rows ``(failure_reason, offending_rows)``."""
    return counted.unpivot([], counted.columns, "failure_reason", "offending_rows")


def referential_breaks(
    fact: DataFrame, key: str, references: Mapping[str, str]
) -> DataFrame:
    """Rows with an unresolved reference (``reason -> key column``) and repeated fact keys."""
    lost = fact.agg(*[F.count_if(F.col(c).isNull()).alias(r) for r, c in references.items()])
    repeated = UniqueCheck("duplicate_line_key", (key,), null_is_value=True).offending(fact)
    repeated = repeated.agg(F.count(F.lit(1)).alias("duplicate_line_key"))
    return violations(lost).unionByName(violations(repeated))


def version_breaks(versions: DataFrame, key: str) -> DataFrame:
    """Keys without exactly one current version, overlapping windows, inverted windows."""
    per_key = versions.groupBy(key).agg(F.count_if("is_current").alias("current_count"))
    current = per_key.agg(F.count_if(F.col("current_count") != 1).alias("missing_current_version"))
    sequenced = number_in_key(
        versions.select(key, "valid_from_date", "valid_to_date"),
        key,
        ["valid_from_date", "valid_to_date"],
        number="_n",
        count="_versions",
        next_value=("valid_from_date", "next_valid_from_date"),
    )
    windows = sequenced.agg(
        F.count_if(F.col("valid_to_date") >= F.col("next_valid_from_date")).alias(
            "overlapping_version_window"
        ),
        F.count_if(F.col("valid_to_date") < F.col("valid_from_date")).alias("inverted_version_window"),
    )
    return violations(current).unionByName(violations(windows))


def unmapped_codes(df: DataFrame, column: str, unknown: str = "Unknown") -> DataFrame:
    """Two-letter upper-case values that no mapping translated, with their row counts."""
    c = F.col(column)
    leftover = df.filter((c != unknown) & (F.length(c) == 2) & (F.upper(c) == c))
    return leftover.groupBy(c.alias(f"unmapped_{column}")).agg(F.count(F.lit(1)).alias("customer_count"))


def rejection_rate(source: DataFrame, retained: DataFrame, cap: float) -> DataFrame:
    """Rows in, rows kept, rows rejected, their share, and whether the share exceeds ``cap``."""
    both = source.select(F.lit(1).alias("came"), F.lit(0).alias("kept")).unionByName(
        retained.select(F.lit(0).alias("came"), F.lit(1).alias("kept"))
    )
    counted = both.agg(
        F.coalesce(F.sum("came"), F.lit(0)).alias("source_row_count"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("retained_row_count"),
    )
    lost = F.col("source_row_count") - F.col("retained_row_count")
    return counted.withColumn("rejected_row_count", lost).withColumns(
        {
            "rejection_rate": F.try_divide(lost.cast("double"), F.col("source_row_count").cast("double")),
            "exceeds_cap": F.coalesce(lost > F.col("source_row_count") * F.lit(cap), F.lit(False)),
        }
    )


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null key the parent lacks."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
