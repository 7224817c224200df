"""Once-per-file ingest of a landing folder with Structured Streaming.

The stream carries file names, not rows: the checkpoint of a file source remembers which files were
handed out, and the header gate needs the names before the rows are read. A micro-batch then loads
its few files through the same code as a batch load.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from silverlode.sources.bronze import Load, load_files, quarantine, write_audit
from silverlode.sources.headers import FILE_SCHEMA
from silverlode.sources.specs import SourceSpec, sources

_BINARY_SCHEMA = T.StructType([*FILE_SCHEMA, T.StructField("content", T.BinaryType())])


def new_files(spark: SparkSession, path: str, files_per_trigger: int) -> DataFrame:
    """Streaming frame of the files below ``path``; the content is never fetched."""
    source = spark.readStream.format("binaryFile").schema(_BINARY_SCHEMA)
    source = source.option("maxFilesPerTrigger", files_per_trigger)
    return source.load(path).select(*FILE_SCHEMA.names)


def ingest_stream(
    spark: SparkSession,
    spec: SourceSpec,
    landing: str,
    bronze: str,
    checkpoints: str,
    files_per_trigger: int = 8,
    keep_extra: bool = True,
) -> list[Load]:
    """Load every file that no earlier run has loaded, then stop.

    ``foreachBatch`` may repeat a micro-batch after a crash, so the bronze batch id is the number of
    the micro-batch under the id that the checkpoint holds: the repeat overwrites its own folder, and a
    new checkpoint never overwrites what another one loaded.
    """
    loads: list[Load] = []
    checkpoint = f"{checkpoints.rstrip('/')}/{spec.table}"

    def identity(files: DataFrame) -> str:
        # Written before the first micro-batch and the same after every restart.
        return json.loads(files.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]

    def load(files: DataFrame, epoch: int) -> None:
        # At most files_per_trigger names.
        listed = files.collect()
        batch_id = f"stream-{identity(files)}-{epoch:08d}"
        done = load_files(files.sparkSession, spec, listed, bronze, batch_id, keep_extra=keep_extra)
        write_audit(files.sparkSession, bronze, [] if done.problem else [done])
        loads.append(done)

    query = (
        new_files(spark, spec.path(landing), files_per_trigger)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return loads


def ingest_streams(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoints: str,
    system: str | None = None,
    files_per_trigger: int = 8,
) -> list[Load]:
    """All extracts, or one system's, each with its own checkpoint, side by side.

    An extract that fails is quarantined; its checkpoint still points before the failed files, so
    the next run takes them up again.
    """

    def one(spec: SourceSpec) -> list[Load]:
        try:
            return ingest_stream(spark, spec, landing, bronze, checkpoints, files_per_trigger)
        except Exception as problem:  # any failure is this extract's alone
            skipped = (spec.pattern.rsplit("/", 1)[-1], str(problem))
            quarantine(spark, bronze, spec.table, [skipped])
            return [Load(spec.table, spec.system, "", 0, 0, 0, "append", str(problem))]

    specs = sources(system)
    with ThreadPoolExecutor(max_workers=len(specs)) as pool:
        return [load for loads in pool.map(one, specs) for load in loads]
