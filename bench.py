"""Benchmark: the registered queries over the whole test tables.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. Each query is executed to completion through the
`noop` sink (the full plan runs, nothing is collected on the driver); the
time per query is the best of $BENCH_REPEAT runs (taken in rounds over all
queries), `value` is their sum.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark.sql import SparkSession

    from revops_spark.plans.queries import MULTI_STEP, QUERIES
    from revops_spark.session import configure

    scratch = tempfile.mkdtemp(prefix="revops-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .appName("revops_spark-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
             # batch job: skip PySpark's per-call call-site capture (error context
             # only); it costs a dozen JVM round trips per Column call
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # load and build are timed only when asked for: they write files and tables
    names = [n for n in QUERIES if (n in only if only else n not in MULTI_STEP)]
    times, errors = {}, {}
    if names:
        try:
            run(names[0])  # warm-up: JVM JIT, file listing
        except Exception:
            pass
    # rounds over all queries, best per query: a burst of machine noise then
    # hits one run of several queries rather than every run of one query
    for _ in range(repeat):
        for n in names:
            if n in errors:
                continue
            try:
                t = run(n)
                times[n] = min(t, times.get(n, t))
            except Exception as exc:  # keep benchmarking the others; report the failure
                errors[n] = f"{type(exc).__name__}: {str(exc)[:200]}"
                times.pop(n, None)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {n: round(t, 3) for n, t in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
