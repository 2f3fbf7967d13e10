"""Times the registered queries on one folder of test tables and prints one JSON line.

BENCH_SF_DIR  folder of test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    timed runs per query after one warm-up (default 3); the median counts
BENCH_ONLY    comma-separated query names (default: all)

``stored_*`` times a model over source tables that were written before, so that its own work shows apart from the
views that shape the test tables (``model_*`` includes those). ``load`` is the machine's load average at the start
and the end: other work on the machine shows there.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.plans import MODELS, build  # noqa: E402
from ledgerspark.settings import SESSION_OPTIONS  # noqa: E402
from ledgerspark.sources import SourceCatalog  # noqa: E402
from verification.erp_views import ErpViews, source_of  # noqa: E402
from verification.queries import CONTEXT, queries  # noqa: E402

STORED_MODELS = ("fact_transactions", "fact_budget", "dim_customer", "dim_chart_of_accounts")


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    options = SESSION_OPTIONS | {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else str(os.cpu_count()),
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
    }
    for name, value in options.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored_models(spark: SparkSession, folder: str) -> dict:
    """The models over Parquet copies of the source tables."""
    views, given = ErpViews(spark, folder), {}
    for name in views.names():
        path = f"{spark.conf.get('spark.checkpoint.dir')}/sources/{name}"
        views.view(name).write.mode("overwrite").parquet(path)
        given[source_of(name)] = path
    sources = SourceCatalog(spark, given=given)
    return {f"stored_{name}": (lambda spark, _, name=name: build(MODELS[name], sources, CONTEXT)) for name in STORED_MODELS}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = session(cpus)
    times, load = {}, [os.getloadavg()[0]]
    for name, query in (queries() | stored_models(spark, folder)).items():
        if only and name not in only:
            continue
        seconds(query, spark, folder)
        times[name] = round(statistics.median(seconds(query, spark, folder) for _ in range(runs)), 4)
    found = re.search(r"sf([\d.]+)", folder)
    load.append(os.getloadavg()[0])
    print(json.dumps({
        "metric": "total_median_seconds",
        "value": round(sum(seconds for name, seconds in times.items() if not name.startswith("stored_")), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1)) if found else None,
        "cpus": cpus,
        "runs": runs,
        "load": [round(x, 1) for x in load],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
