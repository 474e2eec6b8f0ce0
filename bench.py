"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and once on the clock, its result written to a sink
that discards it. ``mart_load`` is the whole load from the order tables; the
queries after it read the tables of a mart loaded beforehand, as reports do.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from monthmart.plans.queries import QUERIES  # noqa: E402
from monthmart.session import local_session  # noqa: E402

HEADLINE = (
    "mart_load", "staging_load", "fact_build", "dim_time", "dim_group", "variation_month", "variation_row_lag",
    "long_delta", "pivot_view", "pivot_avg", "merged_names", "ranking", "market_kpi", "distribution",
    "heat_matrix", "trend_surrogate", "dq_summary", "grid_to_long", "workbook_long", "cache_incremental",
    "number_parse", "period_parse", "headings_catalog", "group_clean",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
