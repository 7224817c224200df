"""Time the headline queries end to end and print one JSON line.

Every query starts from the raw tables: extracts derived, cleaned, conformed, aggregated. No data
is shared between queries. ``BENCH_SF_DIR`` picks the data, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (names separated by commas) a subset.
"""

from __future__ import annotations

import json
import os
import time

from silverlode import get_session
from silverlode.registry.spark_queries import QUERIES

HEADLINE = (
    "kpi_monthly",
    "product_abc",
    "category_rollup",
    "rfm_segments",
    "dim_customers",
    "dim_products_scd2",
    "fct_sales_full",
    "fct_sales_incremental",
    "clean_sales",
    "dedup_latest_events",
    "global_cumsum",
    "ingest_batch_lineage",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = get_session(
        "silverlode-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        # The test tables shuffle a few megabytes: let small partitions keep all cores busy.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One unmeasured query on the smallest tables at hand, so that the first measured one is not charged
    # for starting the engine.
    smallest = f"{os.path.dirname(sf_dir.rstrip('/'))}/sf0.001"
    warm_up = smallest if os.path.isdir(smallest) else sf_dir
    QUERIES["kpi_monthly"](spark, warm_up).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
