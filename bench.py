"""Times the registered queries; prints one JSON line.

Each query runs once to warm up and then `BENCH_RUNS` times; its number is the median. `queries` are
the registered ones, which derive the marts from the benchmark tables inside their plan.
`stored_marts` are the questions again over marts written once before, as a daily run leaves them.
Names as arguments limit the run to those queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from osspulse.session import build_session  # noqa: E402
from osspulse.sinks import Layer, catalog_marts, ensure_layers, write_table  # noqa: E402
from workload.marts import LazyMarts  # noqa: E402
from workload.registry import QUESTIONS, REGISTRY  # noqa: E402


def seconds(query, *arguments) -> float:
    start = time.perf_counter()
    query(*arguments).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(runs: int, query, *arguments) -> float:
    seconds(query, *arguments)
    return round(statistics.median(seconds(query, *arguments) for _ in range(runs)), 4)


def store_marts(spark, sf_dir: str) -> None:
    ensure_layers(spark)
    marts = LazyMarts(spark, sf_dir)
    for name in marts:
        write_table(marts[name], Layer.MARTS.table(name))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="osspulse-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(REGISTRY)
    timed = {name: median(runs, REGISTRY[name], spark, sf_dir) for name in names}

    store_marts(spark, sf_dir)
    stored = {name: median(runs, QUESTIONS[name], catalog_marts(spark)) for name in names if name in QUESTIONS}
    spark.stop()
    result = {"metric": "total_query_seconds", "value": round(sum(timed.values()), 4), "unit": "sec"}
    print(json.dumps({**result, "queries": timed, "stored_marts": stored, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
