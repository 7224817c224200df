"""Secret scans over a history of file versions, with a ledger of blobs already scanned.

Every version's text is content-addressed (SHA-256). The ledger, a Parquet folder, holds one row per
blob and scan: the rule versions that were applied and the spans they found. A scan looks up which
rule versions each blob has seen, runs only the missing ones, appends its rows in one commit and joins
all findings back to every path that holds the blob.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = (
    "blob_id binary, versions array<string>, "
    "spans array<struct<version:string,start:bigint,rank:int,kind:string,end:bigint>>"
)


@dataclass(frozen=True)
class SecretRule:
    """A pattern; matches shorter than ``at_least`` code points in ``group`` are dropped."""

    kind: str
    pattern: str
    at_least: int = 1
    group: int = 0
    base: bool = False

    @property
    def version(self) -> str:
        """Changes with everything that decides what the rule finds."""
        text = f"{self.kind}\n{self.pattern}\n{self.at_least}\n{self.group}"
        return f"{self.kind}-{hashlib.sha256(text.encode()).hexdigest()[:32]}"


# The three base rules, in the order of the contract, then further well-known key formats.
RULES: tuple[SecretRule, ...] = (
    SecretRule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        at_least=6,
        group=2,
        base=True,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", at_least=20, base=True),
    SecretRule("hex", r"[0-9a-f]{24,}", at_least=24, base=True),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)


def _matches(text: Column, rule: SecretRule, rank: int) -> Column:
    """All matches of one rule: what lies between the matches gives their places.

    Texts without a match take the first test only.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda piece: F.length(piece).cast("bigint"))
    found = F.transform(F.regexp_extract_all(text, pattern, 0), lambda m: F.length(m).cast("bigint"))
    decisive = F.transform(F.regexp_extract_all(text, pattern, rule.group), lambda m: F.length(m).cast("bigint"))
    rows = F.transform(
        F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found"), decisive.alias("decisive")), lambda m: m["found"].isNotNull()),
        lambda m, i: F.struct(
            F.lit(rule.version).alias("version"),
            F.lit(rank).alias("rank"),
            F.lit(rule.kind).alias("kind"),
            i.alias("nth"),
            m["gap"].alias("gap"),
            m["found"].alias("found"),
            (m["decisive"] >= rule.at_least).alias("holds"),
        ),
    )
    return F.when(text.rlike(rule.pattern), rows)


def scan_blobs(blobs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Apply to each blob the rules whose versions it has not ``seen``.

    ``blobs`` holds ``blob_id``, ``text`` and ``seen`` (an array of rule versions), one row per blob.
    Returns rows of the ledger. Matches that fail their length are dropped after they have taken their
    place, so nothing inside them is tried again.
    """
    wanted = F.array(*(F.lit(r.version) for r in rules))
    per_rule = [
        F.when(~F.array_contains("seen", r.version), _matches(F.col("text"), r, rank)) for rank, r in enumerate(rules)
    ]
    none = F.array().cast(
        "array<struct<version:string,rank:int,kind:string,nth:int,gap:bigint,found:bigint,holds:boolean>>"
    )
    scanned = blobs.select(
        "blob_id",
        F.array_except(wanted, "seen").alias("versions"),
        F.concat(*(F.coalesce(m, none) for m in per_rule)).alias("matches"),
    )
    # A running sum over the matches of one blob and rule places them; rows follow the blob's partition.
    so_far = "partition by blob_id, m.version order by m.nth rows between unbounded preceding and current row"
    placed = scanned.select("blob_id", "versions", F.explode_outer("matches").alias("m")).select(
        "blob_id", "versions", "m", F.expr(f"sum(m.gap + m.found) over ({so_far})").alias("end")
    )
    span = F.struct(
        F.col("m.version").alias("version"),
        (F.col("end") - F.col("m.found")).alias("start"),
        F.col("m.rank").alias("rank"),
        F.col("m.kind").alias("kind"),
        F.col("end").alias("end"),
    )
    return placed.groupBy("blob_id", "versions").agg(F.collect_list(F.when(F.col("m.holds"), span)).alias("spans"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; a folder that does not exist yet is an empty ledger."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_history(
    history: DataFrame, ledger: str, rules: Sequence[SecretRule] = RULES, *, text: str = "text", out: str = "spans"
) -> DataFrame:
    """Spans of secrets for every row (path version) of ``history``.

    Scans the blobs that the ledger has not seen under the present rule versions and appends them to it.
    Returns the columns of ``history`` but ``text``, with ``out``: an array of (start, rank, kind, end),
    ordered by start and rule; code points, end exclusive. Null texts count as empty; an empty history
    gives an empty result; rows that repeat are kept and share one scan. ``out`` replaces a column of
    that name; other columns may have any name, as those of this operator live in a struct.
    """
    spark = history.sparkSession
    versions = [r.version for r in rules]
    content = F.coalesce(F.col(text), F.lit(""))
    address = F.unhex(F.sha2(content, 256))
    seen = (
        read_ledger(spark, ledger)
        .select("blob_id", F.array_intersect("versions", F.array(*map(F.lit, versions))).alias("v"))
        .groupBy("blob_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("v"))).alias("seen"))
    )
    blobs = history.select(address.alias("blob_id"), content.alias("text")).dropDuplicates(["blob_id"])
    pending = blobs.join(seen, "blob_id", "left").select(
        "blob_id", "text", F.coalesce("seen", F.array().cast("array<string>")).alias("seen")
    )
    fresh = pending.filter(F.size(F.array_except(F.array(*map(F.lit, versions)), "seen")) > 0)
    scan_blobs(fresh, rules).write.mode("append").parquet(ledger)

    # Two scans at the same time may both hold a blob: equal spans count once.
    found = (
        read_ledger(spark, ledger)
        .select("blob_id", F.filter("spans", lambda s: s["version"].isin(versions)).alias("spans"))
        .filter(F.size("spans") > 0)
        .groupBy("blob_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
        .select(
            "blob_id",
            F.array_sort(
                F.transform("spans", lambda s: F.struct(*(s[n].alias(n) for n in ("start", "rank", "kind", "end"))))
            ).alias("spans"),
        )
    )
    kept = [c for c in history.columns if c not in (text, out)]
    paths = history.select(F.struct(*kept).alias("row"), address.alias("blob_id"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return paths.join(found, "blob_id", "left").select("row.*", F.coalesce("spans", none).alias(out))


def join_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def findings(scanned: DataFrame, id_column: str = "doc_id", rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans as text, per row."""
    base = [r.kind for r in rules if r.base]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scanned.select(
        id_column,
        *map(count, base),
        F.sha2(join_spans(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        join_spans(F.col("spans")).alias("spans"),
    )
