"""WARC archives: written from pages, read back in parallel by verifying the chain of records.

Writing: of pages with equal payloads one is a response record, the others refer to it. Records go
through Spark's text sink, whose line separator is the end mark of a record, so archives land wherever
Spark can write.

Reading: tasks cut byte ranges at the magic line, whatever it lies in, and emit for every candidate its
offset and, from its header, that of its successor. Pointer jumping from the start of each file keeps the
candidates that the chain reaches; a magic line inside a payload is on no chain. Only narrow rows take
part; payloads are digested where they are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.session import scratch_path, stash

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n"
END = "\r\n\r\n"
HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcPlan:
    #: Payloads below this many bytes are never revisits.
    min_revisit: int = 1000
    #: Bounds the records that one file's chain can have.
    records_per_file: int = 4096
    #: Groups of equal payloads that are sent to all tasks at most; above, the join is an exchange.
    broadcast_groups: int = 100_000
    date: str = "2026-01-01T00:00:00Z"


def _header(name: str, value: Column | str) -> Column:
    """One header line; nothing where the value is null. Line breaks in values are percent-encoded."""
    text = F.lit(value) if isinstance(value, str) else value
    safe = F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(BREAK)), F.lit(""))


def _page_urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def write_warc(
    pages: DataFrame, folder: str, plan: WarcPlan = WarcPlan(), *, id_column: str = "page_id", url: str = "url", body: str = "html"
) -> None:
    """Write one record per row to archives in ``folder``.

    A null ``body`` is an empty payload, a null ``url`` leaves its header out, a null id is an empty one
    and never the target of a revisit. Rows that repeat the largest id of a payload are all responses.
    """
    payload = F.coalesce(F.col(body), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("id"), F.col(url).alias("url"), payload.alias("payload"),
        F.octet_length(payload).alias("bytes"), F.sha1(payload.cast("binary")).alias("digest"),
    )
    groups = (
        rows.filter(F.col("bytes") >= plan.min_revisit)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("id").alias("first"))
        .filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    groups = stash(groups, "equal-payloads")
    # The size is checked before the groups are sent to every task.
    if groups.count() <= plan.broadcast_groups:
        groups = F.broadcast(groups)
    marked = rows.join(groups, "digest", "left")
    revisits = F.when((F.col("bytes") >= plan.min_revisit) & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    http = F.concat(F.lit(HTTP_OK), F.col("bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(F.col("refers").isNull(), F.col("payload")).otherwise(F.lit("")))
    head = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(F.col("refers").isNull(), "response").otherwise("revisit")),
        _header("WARC-Record-ID", F.coalesce(_page_urn(F.col("id")), F.lit("<urn:page:>"))),
        _header("WARC-Date", plan.date),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Refers-To", _page_urn(F.col("refers"))),
        _header("WARC-Profile", F.when(F.col("refers").isNotNull(), REVISIT_PROFILE)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("Content-Type", "application/http;msgtype=response"),
        _header("Content-Length", F.octet_length("block").cast("string")),
        F.lit(BREAK),
    )
    record = marked.withColumn("refers", revisits).withColumn("block", block).select(F.concat(head, "block").alias("value"))
    record.write.option("lineSep", END).option("maxRecordsPerFile", plan.records_per_file).text(folder)


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?:^|\n){name}: ([^\r\n]*)", 1), F.lit(""))


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between magic lines, as bytes, with its file, byte range and place in it."""
    text = spark.read.option("lineSep", MAGIC).text(folder)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").cast("binary").alias("bytes"),
    )


def candidates(chunks: DataFrame) -> DataFrame:
    """Every candidate record: its offset, that of its successor (null without a valid header), its fields.

    ``payload_sha1`` is the digest of what follows the HTTP header, if the chunk is the whole record.
    """
    head = F.substring_index(F.col("bytes").cast("string"), END, 1)
    parsed = chunks.select("*", F.octet_length("bytes").alias("size"), head.alias("head")).withColumn(
        "cut", F.octet_length("head") + 1
    )
    length = F.regexp_extract("head", r"(?:^|\n)Content-Length: ([0-9]+)(?:\r|$)", 1).try_cast("bigint")
    fields = parsed.select(
        "file", "block", "nth", "size",
        F.when(F.col("cut") < F.col("size"), F.col("cut") + 3 + length).alias("content"),
        _field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("record"),
        _field("WARC-Refers-To").alias("refers"), _field("WARC-Payload-Digest").alias("digest"),
        F.expr("substring(bytes, cut + 4)").alias("rest"),
    )
    whole = F.col("size") == F.col("content") + len(END)
    block = F.expr(f"substring(rest, 1, length(rest) - {len(END)})")
    narrow = fields.select(
        "file", "block", "nth", "size", "content", "type", "record", "refers", "digest",
        *_http_fields(F.when(whole, block)),
    )
    # Two steps place the chunks: sums inside each byte range, and the sizes of the ranges before it.
    step = len(MAGIC)
    inside = f"sum(size + {step}) over (partition by file, block order by nth rows between unbounded preceding and current row)"
    narrow = stash(narrow.withColumn("upto", F.expr(inside)), "warc-chunks")
    ranges = narrow.groupBy("file", "block").agg(F.max("upto").alias("bytes"))
    before = "sum(bytes) over (partition by file order by block rows between unbounded preceding and current row) - bytes"
    starts = ranges.select("file", "block", F.expr(before).alias("before"))
    offset = F.col("before") + F.col("upto") - F.col("size") - 2 * step
    placed = narrow.join(starts, ["file", "block"]).withColumn("offset", offset).filter("offset >= 0")
    successor = F.col("offset") + step + F.col("content") + len(END)
    return placed.select(
        "file", "offset", successor.alias("successor"), "nth", "size", "content", "type", "record", "refers", "digest",
        "payload_bytes", "payload_sha1",
    )


def _http_fields(block: Column) -> tuple[Column, Column]:
    """Stated length of the HTTP payload, and the digest of the payload that is there."""
    end = F.position(F.lit(END.encode()), block)
    head = F.substring(block, F.lit(1), end).cast("string")
    stated = F.regexp_extract(head, r"\nContent-Length: ([0-9]+)\r", 1).try_cast("bigint")
    return stated.alias("payload_bytes"), F.sha1(F.substring(block, end + 4, F.octet_length(block))).alias("payload_sha1")


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from the start of each file, by pointer jumping.

    ``links`` holds ``file``, ``offset`` and ``successor``. In each round every pointer takes the pointer
    of where it points to, and what a reached candidate points to is reached: after k rounds pointers
    span 2^k records. The work ends when no pointer is left, after the logarithm of the longest chain.
    """
    known = links.select("file", F.col("offset").alias("target"))
    start = links.select("file", "offset", F.col("successor").alias("target"), (F.col("offset") == 0).alias("reached"))
    # Pointers to places that are no candidate end the chain.
    table = stash(
        start.join(known.withColumn("known", F.lit(True)), ["file", "target"], "left").select(
            "file", "offset", F.when(F.col("known"), F.col("target")).alias("target"), "reached"
        ),
        "warc-chain",
    )
    while not table.filter("target is not null").isEmpty():
        hits = table.filter("reached and target is not null").select("file", F.col("target").alias("offset"), F.lit(True).alias("hit"))
        jumps = table.select("file", F.col("offset").alias("target"), F.col("target").alias("further"))
        table = stash(
            table.join(hits.distinct(), ["file", "offset"], "left")
            .join(jumps, ["file", "target"], "left")
            .select("file", "offset", F.col("further").alias("target"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached")),
            "warc-chain",
        )
    return table.filter("reached").select("file", "offset")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every record on the chains of the archives in ``folder``, verified against its payload digest.

    Columns: ``record`` (id), ``type``, ``refers``, ``payload_bytes``, ``digest``, ``file``, ``offset``,
    ``intact`` (the payload that was read has the stated digest; null for revisits, which carry none).
    """
    found = stash(candidates(read_chunks(spark, folder)), "warc-candidates")
    chain = stash(found.join(reachable(found.select("file", "offset", "successor")), ["file", "offset"]), "warc-records")
    split = chain.filter("payload_bytes is null and content is not null")
    records = chain.filter("payload_bytes is not null")
    if not split.isEmpty():
        records = records.unionByName(_reassembled(spark, folder, found, split))
    intact = F.when(F.col("type") == "response", F.concat(F.lit("sha1:"), "payload_sha1") == F.col("digest"))
    return records.select("record", "type", "refers", "payload_bytes", "digest", "file", "offset", intact.alias("intact"))


def _reassembled(spark: SparkSession, folder: str, found: DataFrame, split: DataFrame) -> DataFrame:
    """Records whose payload holds the magic line: their chunks are read again and put together."""
    # The owner of a chunk is the last split record that starts at or before it; a file's rows are bounded.
    starts = split.select("file", "offset", F.col("offset").alias("owner"), "successor")
    last = "last(if(owner is null, null, struct(owner, successor)), true) over (partition by file order by offset)"
    parts = (
        found.select("file", "offset", "nth")
        .join(starts, ["file", "offset"], "left")
        .select("nth", "file", "offset", F.expr(last).alias("o"))
        .filter("offset < o.successor")
        .select("nth", "file", "offset", "o.owner")
    )
    pieces = read_chunks(spark, folder).select("nth", "bytes").join(parts, "nth")
    in_order = F.array_sort(F.collect_list(F.struct("offset", F.hex("bytes").alias("hex"))))
    magic = MAGIC.encode().hex().upper()
    joined = pieces.groupBy("file", "owner").agg(F.array_join(F.transform(in_order, lambda p: p["hex"]), magic).alias("hex"))
    whole = joined.select("file", F.col("owner").alias("offset"), F.unhex("hex").alias("bytes"))
    block = F.expr(f"substring(rest, 1, length(rest) - {len(END)})")
    cut = F.octet_length(F.substring_index(F.col("bytes").cast("string"), END, 1)) + 1
    read = whole.select("file", "offset", F.substring("bytes", cut + len(END), F.octet_length("bytes")).alias("rest"))
    fields = read.select("file", "offset", *_http_fields(block))
    return split.drop("payload_bytes", "payload_sha1").join(fields, ["file", "offset"]).select(split.columns)


def page_records(records: DataFrame, id_type: str = "bigint", id_column: str = "page_id") -> DataFrame:
    """Records written by ``write_warc``, with ids as they were: one row per page.

    A damaged record is an error, not a row.
    """
    def page(urn: Column) -> Column:
        return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)

    sound = F.coalesce(F.col("intact"), F.lit(True))
    digest = F.when(sound, F.regexp_replace("digest", "^sha1:", "")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record at "), "file", F.lit(" "), F.col("offset").cast("string")))
    )
    return records.select(
        page(F.col("record")).alias(id_column), "payload_bytes", digest.alias("payload_digest"),
        F.col("type").alias("record_type"), page(F.col("refers")).alias("refers_to"),
    )


def round_trip(pages: DataFrame, plan: WarcPlan = WarcPlan(), *, id_column: str = "page_id") -> DataFrame:
    """Write the pages to new archives in the shared scratch folder and read the records back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_warc(pages, folder, plan, id_column=id_column)
    return page_records(read_warc(spark, folder), pages.schema[id_column].dataType.simpleString(), id_column)
