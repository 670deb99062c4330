"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layerloom.operators.staging import clear_staged  # noqa: E402
from layerloom.session import local_session  # noqa: E402
from layerloom.suite.queries import QUERIES  # noqa: E402

HEADLINE = [
    "typed_silver",
    "bronze_rejects",
    "audit_counts",
    "dedupe_exact",
    "dedupe_by_key",
    "latest_per_key",
    "surrogate_keys",
    "scd2_merge",
    "provider_assignment",
    "provider_round_robin",
    "fact_encounters_one",
    "fact_encounters_all",
    "encounter_overview",
    "financial_analytics",
    "provider_performance",
    "financial_analytics_all",
    "provider_performance_all",
    "scd2_delta_apply",
    "metric_provider_rollup_exact",
    "kpi_from_rollup",
    "report_bundle",
    "overview_two_key_join",
    "metric_by_stage",
    "kpi_summary",
    "stage_distribution",
    "top_providers_by_response",
    "dq_summary",
    "profile_columns",
]


def seconds(spark, run) -> float:
    """Plan, execute and discard the rows; the better of two runs."""
    best = float("inf")
    for _ in range(2):
        begin = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - begin)
        clear_staged(spark)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("layerloom-bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times, failed = {}, {}
    for name in names:
        try:
            times[name] = seconds(spark, lambda q=QUERIES[name]: q(spark, sf_dir))
        except Exception as error:  # the others are timed all the same
            failed[name] = f"{type(error).__name__}: {error}"[:300]
    spark.stop()
    line = {
        "metric": "total seconds over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))


if __name__ == "__main__":
    main()
