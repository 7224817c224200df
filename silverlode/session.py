"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One customer or product may own a third of the sales: let the join split its partition even
    # where that costs another exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: Of tables and frames of many lines: hashed keys and other long texts take little more than half of what snappy leaves.
CODEC = "zstd"


def get_session(app: str = "silverlode", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there driver and executors are
    one process. On a cluster an unset folder is an error, never a machine-local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    """One folder per process: ``spark.checkpoint.dir`` cannot be set on a running session."""
    return tempfile.mkdtemp(prefix="silverlode-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared scratch folder (not created)."""
    return f"{scratch_root(spark)}/silverlode/{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and fixes the rows: later jobs over the result agree with each other, and a
    lost executor only costs a re-read. Ranges and broadcasts are chosen by the bytes of the files, so only frames
    that are merely read again take another ``codec``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
