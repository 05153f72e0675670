"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built from the tables and executed in full with the ``noop``
sink (every row produced, no driver transfer).  After one warm-up pass over all
queries, ``BENCH_RUNS`` (default 5) interleaved passes are timed; the reported
time per query is the median, including building the DataFrame.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voltaic.plans.catalog import QUERIES  # noqa: E402
from voltaic.session import get_session  # noqa: E402

HEADLINE = {
    "q_accuracy_daily": "AGG-4",       # flagship: filter + daily accuracy aggregate
    "q_renewable_totals": "PIP-3",     # union + hourly totals
    "q_generation_profile": "AGG-8",   # approx quantiles per hour
    "q_curtailment_daily": "AGG-13",   # per-day aggregates then join
    "q_solar_features": "PIP-12",      # blocked lag/rolling windows
    "q_price_statistics": "PIP-13",    # exact percentiles per point-day
    "q_hub_comparison": "PIP-14",      # pivot + spreads
    "q_volatility": "PIP-15",          # per-hub rolling windows
    "q_price_vs_generation": "PIP-16", # join + daily aggregate
    "q_regional_unpivot": "PIP-4",     # orders x customer x nation x region, unpivot
    "q_dedupe_latest": "WIN-1",        # keep-newest per key on lineitem
    "q_quality_report": "QC-8",        # checks over several tables
    "q_upsert": "SNK-5",               # keyed upsert into a partitioned table
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                        extra={"spark.driver.memory": "16g"})
    def run(qid: str) -> float:
        t0 = time.perf_counter()
        QUERIES[qid](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for qid in HEADLINE.values():          # warm-up pass over every query (JIT, file listings)
        run(qid)
    samples: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(runs):                  # interleaved timed passes
        for name, qid in HEADLINE.items():
            samples[name].append(run(qid))
    times = {name: round(statistics.median(v), 4) for name, v in samples.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
