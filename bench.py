"""Times the headline queries: warm median of three runs each, one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every row of a result
is computed and thrown away (``noop`` sink). The silver and gold steps find their order rows,
targets, batches and feeds as written tables, as in a job; writing those is not timed. All else
starts from the test tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators import merge
from tierflow.operators.enrich import enrich_star
from tierflow.plans import gold, sample, silver
from tierflow.plans.registry import QUERIES
from tierflow.session import build_session, scratch_path
from tierflow.sources.tables import stage

Timed = Callable[[], DataFrame]


def scd1_merge(spark: SparkSession, sf_dir: str) -> Timed:
    before, batch = sample.fact1_states(spark, sf_dir)
    return lambda: gold.fact_scd1(before, batch)


def scd2_merge(spark: SparkSession, sf_dir: str) -> Timed:
    before, batch = sample.fact2_states(spark, sf_dir)
    return lambda: gold.fact_scd2(before, batch, sample.RUN)


def snapshot_diff(spark: SparkSession, sf_dir: str) -> Timed:
    before, after = sample.silver_states(spark, sf_dir)
    return lambda: merge.snapshot_diff(before, after, silver.SILVER_KEYS)


def cdc_apply(spark: SparkSession, sf_dir: str) -> Timed:
    before, after = sample.silver_states(spark, sf_dir)
    feed = stage(merge.snapshot_diff(before, after, silver.SILVER_KEYS), scratch_path(spark, "feed"))
    return lambda: silver.silver_apply(before, feed)


def fact(how: str, with_employee: bool = False, plants: int = 1) -> Callable[..., Timed]:
    def prepare(spark: SparkSession, sf_dir: str) -> Timed:
        orders = stage(sample.order_rows(spark, sf_dir), scratch_path(spark, "orders"))
        dims = sample.dims(spark, sf_dir, plants)
        return lambda: enrich_star(orders, dims, how, with_employee)
    return prepare


def silver_dedupe(spark: SparkSession, sf_dir: str) -> Timed:
    bronze = stage(sample.bronze_with_copies(spark, sf_dir), scratch_path(spark, "bronze"))
    return lambda: silver.silver_dedupe(bronze)


def registered(name: str) -> Callable[[SparkSession, str], Timed]:
    return lambda spark, sf_dir: lambda: QUERIES[name](spark, sf_dir)


HEADLINE = {
    "silver_dedupe": silver_dedupe, "fact_full_load": fact("left"),
    "fact_full_load_fanout": fact("left", plants=3), "fact_inner_employee": fact("inner", True),
    "scd1_merge": scd1_merge, "scd2_merge": scd2_merge, "snapshot_diff": snapshot_diff,
    "cdc_apply": cdc_apply,
    **{name: registered(name) for name in (
        "silver_orders", "word_count", "line_token_count", "bronze_incremental", "history_watermark_all", "surrogate_keys")},
    # whole jobs, with the tables they write: loads in several steps, partitioned tables, streams
    **{name: registered(name) for name in (
        "ingest_boundary_rows", "scd1_load", "scd1_partitioned_load", "scd2_touched_load", "dim_product_merge",
        "stream_word_count", "stream_cdc_apply",
        "cdc_apply_sequenced", "snapshot_diff_digest", "fact_versioned_product", "stream_quarantine")},
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(query: Timed) -> float:
        start = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    found = {}
    for name in sys.argv[1:] or HEADLINE:
        query = HEADLINE.get(name, registered(name))(spark, sf_dir)
        seconds(query)
        found[name] = round(statistics.median(seconds(query) for _ in range(3)), 3)
    spark.stop()
    print(json.dumps({"metric": "sum of warm median query times", "value": round(sum(found.values()), 3),
                      "unit": "sec", "queries": found, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
