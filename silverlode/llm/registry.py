"""The queries of this subpackage over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import (
    decontaminate,
    filter_audit,
    line_dedup,
    line_quality,
    near_dedup,
    packing,
    periodic_runs,
    pii_spans,
    secret_scan,
    sharding,
    simhash,
    url_filter,
    warc,
)
from silverlode.llm.common import WORD_PATTERN, let, read_table
from silverlode.llm.oracles import DECONTAMINATE, FILTER_AUDIT, LINE_DEDUP, PERIODIC_RUNS, QUALITY_RULES, SECRET_SCAN, WARC_CHAIN
from silverlode.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op2_secret_scan": SECRET_SCAN,
    "op4_quality_rules": QUALITY_RULES,
    "op6_warc_chain": WARC_CHAIN,
    "op7_line_dedup": LINE_DEDUP,
    "op8_decontaminate": DECONTAMINATE,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_periodic_runs": PERIODIC_RUNS,
}

# The rules of the contract.
URL_RULES = (
    url_filter.UrlRule("block", "net", "/"),
    url_filter.UrlRule("allow", "example.net", "/en/"),
    url_filter.UrlRule("block", "example.com", "/de/"),
    url_filter.UrlRule("allow", "org", "/fr/"),
)


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.score")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.findings(secret_scan.scan_history(docs, scratch_path(spark, "secret-ledger")))


def packing_plan() -> packing.PackingPlan:
    """The plan of the contract, with the vocabulary installed beside the libraries."""
    import public_tokenizers

    return packing.PackingPlan(tokenizer=public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.piece_digests(packing.pack(docs, packing_plan()))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return line_quality.assess(docs).select("doc_id", *(F.col(f"quality.{n}").alias(n) for n in names))


@query
def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans.findings(pii_spans.find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))


@query
def op9_shard_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "benchmark.n_words", "benchmark.n_hit", F.size("benchmark.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("benchmark.items", ","), 256).alias("items_sha256"), (F.col("benchmark.n_hit") > 0).alias("contaminated"),
    )


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = filter_audit.mask_cells(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return filter_audit.audit(cells)


def with_planted_cycles(docs: DataFrame) -> DataFrame:
    """``docs`` where the contract lets the words of a tenth of the texts repeat from some word on."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def cycled(words, g):
        n = F.size(words).cast("bigint")

        def repeated(place):
            period = 1 + F.floor((n - place) / (3 + g % 8))
            block = F.slice(words, (place + 1).cast("int"), period.cast("int"))
            times = F.ceil((n - place) / period).cast("int")
            tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - place).cast("int"))
            return F.array_join(F.concat(F.slice(words, F.lit(1), place.cast("int")), tail), " ")

        return F.when(n > 0, let(g % n, repeated))

    words = F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))
    planted = F.when(number % 10 == 0, let(words, lambda w: cycled(w, F.floor(number / 10))))
    return docs.withColumn("text", F.coalesce(planted, F.col("text")))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_cycles(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    runs = F.col("periodic.runs")
    # Runs come by start and period, so the first of the greatest is the one asked for.
    best = F.reduce(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    found = periodic_runs.find_runs(docs).select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )
    exponent = F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


@query
def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
