"""Benchmark: the pipeline and the headline queries at $BENCH_SF_DIR.

Runs on local[$BENCH_CPUS]. Lands bronze, builds silver and gold once
(written to the session's checkpoint folder and read back), then times
every analytics query on the written gold and the data-quality reports on
the landed bronze and the written silver/gold.
Per-query figures are the median of 3 runs after one warm-up. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators.conform import dedupe  # noqa: E402
from tessera.plans import analytics as A  # noqa: E402
from tessera.plans import profiling as P  # noqa: E402
from tessera.plans.pipeline import land_bronze, run_pipeline  # noqa: E402
from tessera.plans.tables import RetailTables  # noqa: E402
from tessera.session import checkpoint_dir, get_spark  # noqa: E402
from tessera.sources.retail_views import read_table  # noqa: E402


def _sink(df):
    """Run a query to completion without collecting its rows."""
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat=3, warm=True):
    if warm:
        fn()
    times = []
    for _ in range(repeat):
        t0 = time.time()
        fn()
        times.append(time.time() - t0)
    return statistics.median(times)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app_name="tessera-bench",
                      shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    base = f"{checkpoint_dir(spark)}/bench-{uuid.uuid4().hex[:8]}"
    out: dict[str, float] = {}

    li = read_table(spark, sf_dir, "lineitem")
    out["dedupe_line_items"] = timed(lambda: _sink(dedupe(li, ["l_orderkey", "l_linenumber"])))

    t = RetailTables(spark, sf_dir)
    timings: dict[str, float] = {}
    t0 = time.time()
    bronze = land_bronze(t.all_bronze(), base, timings=timings)
    silver, gold = run_pipeline(bronze, base, timings=timings)
    total_pipeline = time.time() - t0
    out["bronze_total"] = sum(v for k, v in timings.items() if k.startswith("bronze_"))
    out["stg_total"] = sum(v for k, v in timings.items() if k.startswith("stg_"))
    out["gold_total"] = sum(v for k, v in timings.items()
                            if not k.startswith(("stg_", "bronze_")) and k != "checks")
    out["pipeline_checks"] = timings["checks"]
    out["pipeline_total"] = total_pipeline

    for name in A.QUERIES:
        out[name] = timed(lambda name=name: _sink(A.run(name, gold)))

    both = {**silver, **gold}
    dq = 0.0
    for name, build in P.BRONZE_REPORTS.items():
        dq += timed(lambda build=build: _sink(build(bronze.__getitem__, t.profiling_order_items)),
                    repeat=1, warm=False)
    for name, build in P.CONSTRAINT_REPORTS.items():
        dq += timed(lambda build=build: _sink(build(both)), repeat=1, warm=False)
    out["dq_total"] = dq

    headline = sum(out[q] for q in A.QUERIES if q.startswith("q"))  # the reference's Q1a-Q8c
    print(json.dumps({
        "metric": "analytics_15_queries_total_on_written_gold",
        "value": round(headline, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in out.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "shuffle_partitions": int(cpus) * 2,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
