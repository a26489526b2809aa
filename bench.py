"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the local cores,
BENCH_RUNS the timed runs of each query after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from clearwell.contracts import ORDERS
from clearwell.plans.batch import run_batch
from clearwell.session import build_session
from clearwell.workloads import REGISTRY, shapes
from clearwell.workloads.registry import Tables

HEADLINE = (
    "daily_revenue",
    "revenue_by_day",
    "top_products",
    "customer_history",
    "status_breakdown",
    "event_distribution",
    "traffic",
    "funnel",
    "dedup_rows",
    "duplicate_count",
    "apply_contract",
    "date_partitions",
    "quality_metrics",
    "quarantine_reasons",
    "route_uploads",
    "routing_summary",
    "column_profile",
    "batch_metrics",
    "batch_daily_revenue",
    "partitioned_readback",
    "catalog_scan",
    "jsonl_scan",
    "gzip_csv_scan",
    "stream_ingest",
    "stream_parquet_ingest",
    "land_raw",
)


def _consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(run: Callable[[], None], runs: int) -> float:
    run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def single_pass(t: Tables) -> None:
    run_batch(shapes.messy_orders(t), ORDERS, t.scratch("bench"), "b1")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "clearwell-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": str(cpus),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    seconds = {name: _median(lambda n=name: _consume(REGISTRY[n].run(Tables(spark, folder))), runs) for name in HEADLINE}
    seconds["batch_single_pass"] = _median(lambda: single_pass(tables), runs)
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
