"""Time the headline queries and the four full builds; print one JSON line.

``BENCH_SF_DIR`` names the folder of benchmark tables, ``BENCH_CPUS`` the local cores.
A build is the whole gated run of a domain: intermediate, marts, every declared check and
publication.  Queries run into Spark's no-op sink, so nothing is collected on the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import OBSERVED, QUERIES  # noqa: E402
from tallywork.plans import DOMAINS, run_domain  # noqa: E402
from tallywork.session import local_session, shared_dir  # noqa: E402
from tallywork.sources.adapters import Feeds  # noqa: E402

HEADLINE = [
    "mart_monthly_revenue", "mart_revenue", "mart_driver_performance", "mart_rider_activity", "mart_marketplace_kpis",
    "mart_subscriber_churn", "mart_churn_summary", "mart_enrollment_completion", "mart_completion_summary",
    "stg_01_payments", "stg_02_driver_incentives", "stg_03_usage", "stg_09_lessons", "dedup_latest", "overlap_matrix",
    "gap_drivers", "dq_report", "fx_asof", "trip_distance", "profile_table", "stream_daily_usage",
]


def run_query(name: str, spark, folder: str) -> None:
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def run_build(name: str, spark, folder: str, out: str) -> None:
    """A full build with the checks, tie-outs and severities that the domain declares."""
    domain = DOMAINS[name]
    options = OBSERVED if name == "telecom" else {}
    run_domain(spark, domain, Feeds(spark, folder).raw(name), out, "bench", **options)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    out = f"{shared_dir(spark)}/bench"
    run_query("mart_revenue", spark, folder)  # start the JVM's code paths before the clock runs
    timings: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        run_query(name, spark, folder)
        timings[name] = round(time.perf_counter() - started, 3)
    for name in DOMAINS:
        started = time.perf_counter()
        run_build(name, spark, folder, f"{out}/{name}")
        timings[f"build_{name}"] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(folder).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
