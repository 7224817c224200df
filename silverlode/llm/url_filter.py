"""URL filter: host and path rules first, then a ratio of two character language models.

Two smoothed variable-order Markov models, one of the URLs that rules accept and one of those they
reject, give every other URL a length-normalised log-likelihood difference. The cut is calibrated on
decided URLs that were held out of the counts. Counting, smoothing and scoring are aggregates and joins
of n-gram tables, all in DataFrame operations.

Scale: URLs are made distinct first, n-grams are counted with partial aggregates, and what the models
gather grows with the URLs. A frequent n-gram occurs once in nearly every URL; its rows in the scoring
join are dealt over ``salts`` partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import ascii_lower
from silverlode.session import stash

START, END = "\x02", "\x03"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    #: Characters of context at most.
    order: int = 4
    #: Probability of a character where no context is known.
    base: float = 1 / 256
    #: One decided URL in this many is held out for the cut.
    holdout: int = 10
    #: Share of held-out accepted URLs that the cut may reject.
    lost: float = 0.02
    salts: int = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a text without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    given = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(given, pattern, 1)), F.regexp_extract(given, pattern, 2)


def model_text(url: Column) -> Column:
    """What the models read: the whole URL, with its host in lower case; empty for a null."""
    given = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^(.*?://)([^/?#]*)(.*)$"
    parts = [F.regexp_extract(given, pattern, n) for n in (1, 2, 3)]
    return F.when(given.contains("://"), F.concat(parts[0], ascii_lower(parts[1]), parts[2])).otherwise(given)


def match_rules(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest fitting rule as a struct of text and verdict, or null. Ties go to the first listed."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: -len(r.text))[::-1]:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(text: Column, order: int) -> Column:
    """Every character with the ``order`` characters before it, the end included."""
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    return F.transform(
        F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(order + 1))
    )


def gram_scores(grams: DataFrame, model: UrlModel) -> DataFrame:
    """log P(accepted) - log P(rejected) of the last character of each gram, given what precedes it.

    ``grams`` holds ``gram``, ``n_a`` and ``n_r`` (occurrences in the two classes, 0 included). At each
    order the counts are mixed with the next shorter context in proportion to the number of different
    characters that followed the context (Witten-Bell); a context never seen leaves the shorter one.
    """
    order = model.order
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda n: F.right(F.col("gram"), n))
    keys = (
        grams.select(F.explode(suffixes).alias("key"), "n_a", "n_r")
        .groupBy("key")
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))
        .withColumn("context", F.expr("left(key, length(key) - 1)"))
    )
    contexts = keys.groupBy("context", F.length("key").alias("size")).agg(
        F.sum("n_a").alias("all_a"),
        F.sum("n_r").alias("all_r"),
        F.count_if(F.col("n_a") > 0).alias("kinds_a"),
        F.count_if(F.col("n_r") > 0).alias("kinds_r"),
    )
    counted = stash(keys.join(contexts, "context"), "url-grams")

    def mixed(c: str, shorter: Column) -> Column:
        total = F.col(f"all_{c}") + F.col(f"kinds_{c}")
        return F.when(total > 0, (F.col(f"n_{c}") + F.col(f"kinds_{c}") * shorter) / total).otherwise(shorter)

    base = F.lit(model.base)
    level = counted.filter("size = 1").select("key", mixed("a", base).alias("p_a"), mixed("r", base).alias("p_r"))
    for size in range(2, order + 2):
        shorter = level.select(F.col("key").alias("tail"), F.col("p_a").alias("q_a"), F.col("p_r").alias("q_r"))
        level = (
            counted.filter(F.col("size") == size)
            .withColumn("tail", F.expr("substring(key, 2)"))
            .join(shorter, "tail")
            .select("key", mixed("a", F.col("q_a")).alias("p_a"), mixed("r", F.col("q_r")).alias("p_r"))
        )
    return level.select(F.col("key").alias("gram"), (F.ln("p_a") - F.ln("p_r")).alias("ratio"))


def score_urls(urls: DataFrame, model: UrlModel) -> DataFrame:
    """``urls`` (distinct ``url``, ``text``, ``n_a``, ``n_r``) with ``score``, the mean ratio per character."""
    ids = [F.xxhash64("url").alias("id"), F.hash("url").alias("id2")]
    rows = urls.select(*ids, "n_a", "n_r", F.explode(_grams(F.col("text"), model.order)).alias("gram"))
    grams = rows.groupBy("gram").agg(F.sum("n_a").alias("n_a"), F.sum("n_r").alias("n_r"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(model.salts - 1))).alias("salt")
    ratios = gram_scores(grams, model).select("gram", "ratio", salts)
    dealt = rows.select("id", "id2", "gram", F.pmod("id", F.lit(model.salts)).cast("int").alias("salt"))
    scores = dealt.join(ratios, ["gram", "salt"]).groupBy("id", "id2").agg(F.avg("ratio").alias("score"))
    return urls.select("*", *ids).join(scores, ["id", "id2"], "left").drop("id", "id2")


def filter_urls(
    pages: DataFrame, rules: Sequence[UrlRule], model: UrlModel = UrlModel(), *, url: str = "url", out: str = "judged"
) -> DataFrame:
    """``pages`` with a struct ``out``: host, path, rule, verdict, score and cut.

    The rule's verdict holds where a rule fits; elsewhere a URL is allowed if its score reaches the cut.
    The models read the whole URL, query and fragment too, also one without ``://``; a null is an empty text.
    The cut is the ``lost`` quantile of the held-out accepted URLs' scores (0 if there are none). Rows that
    repeat are all judged alike and weigh in the counts as often as they occur. Empty tables give empty results.
    Only ``out`` is replaced; other columns may have any name.
    """
    spark = pages.sparkSession
    distinct = pages.select(F.coalesce(F.col(url), F.lit("")).alias("url")).groupBy("url").agg(F.count("*").alias("n"))
    host, path = split_url(F.col("url"))
    ruled = distinct.select("url", "n", host.alias("host"), path.alias("path")).withColumn(
        "rule", match_rules(F.col("host"), F.col("path"), rules)
    )
    held = F.pmod(F.xxhash64("url", F.lit("held out")), F.lit(model.holdout)) == 0

    def counts(verdict: str) -> Column:
        return F.when((F.col("rule.verdict") == verdict) & ~held, F.col("n")).otherwise(0)

    urls = ruled.select(
        "url", "n", "host", "path", "rule", held.alias("held"),
        model_text(F.col("url")).alias("text"), counts("allow").alias("n_a"), counts("block").alias("n_r"),
    )
    scored = stash(score_urls(urls, model), "url-scores")
    accepted = scored.filter("held and rule.verdict = 'allow'")
    cut = accepted.agg(F.percentile_approx("score", F.lit(model.lost), F.lit(10_000))).first()[0]
    cut = F.lit(0.0 if cut is None else float(cut))
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    judged = scored.select(
        F.col("url").alias("_url"),
        F.struct(
            "host", "path", F.col("rule.text").alias("rule"),
            F.coalesce(F.col("rule.verdict"), by_model).alias("verdict"), "score", cut.alias("cut"),
        ).alias("_judged"),
    )
    kept = [c for c in pages.columns if c != out]
    rows = pages.select(F.struct(*kept).alias("_row"), F.coalesce(F.col(url), F.lit("")).alias("_url"))
    return rows.join(judged, "_url").select("_row.*", F.col("_judged").alias(out))
