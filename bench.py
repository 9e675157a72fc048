"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

One warm-up run of every query (JIT and code generation settle), then per
query three consecutive timed runs; the median per query is reported. Every
run executes the full plan into Spark's no-op sink (nothing is collected to
the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from watchfold.plans.registry import QUERIES  # noqa: E402
from watchfold.session import build_session, ensure_checkpoint_dir  # noqa: E402

HEADLINE = ["fact_interaction", "fact_behavior", "program_duration_stats", "top10_by_program"]
EXTRA = ["fact_interaction_stepwise", "active_days_distribution", "genre_change_percent",
         "label_genres", "bridge_synth"]
RUNS = 3


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="watchfold-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bench-wh-")})
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)       # the configured folder; a scratch one only if none is set
    names = HEADLINE + EXTRA
    for name in names:                                      # the one warm-up per query
        run_once(spark, name, sf_dir)
    medians = {}
    for name in names:
        medians[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(RUNS)), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_median_sum",
        "value": round(sum(medians[n] for n in HEADLINE), 3),
        "unit": "sec",
        "queries": medians,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
