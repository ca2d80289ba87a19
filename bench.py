"""Benchmark: the nightly ETL plus headline queries at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full through the ``noop`` sink (no collect);
``etl`` is one complete star load into a fresh scratch folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyfold.plans import registry  # noqa: E402
from skyfold.plans.catalog import QUERIES  # noqa: E402
from skyfold.plans.etl import run_etl  # noqa: E402
from skyfold.session import checkpoint_dir, get_spark  # noqa: E402

HEADLINE = [
    "occupancy_by_route", "revenue_by_fare", "cancellation_patterns", "lead_time_by_class",
    "fact_ticket_sale", "fact_flight_occupancy", "fact_reservation_lifecycle",
    "flight_availability", "cheapest_eligible_fare", "one_stop_connections", "search_offers",
    "materialize_flights", "inventory_reconciliation", "inventory_from_events",
    "quote_segments", "seat_admission", "issue_tickets", "agency_credit_ledger",
    "dq_range_checks", "dq_unique_checks", "dq_foreign_keys", "star_vs_source",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = get_spark(f"local[{cpus}]", app="skyfold-bench", shuffle_partitions=max(8, 2 * cpus))
    checkpoint_dir(spark)      # the configured shared folder; a local one only when none is set
    registry.load_all()
    times: dict[str, float] = {}

    # JVM / codegen warm-up, reported apart from the query times
    t0 = time.perf_counter()
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    warmup = round(time.perf_counter() - t0, 3)

    out_dir = tempfile.mkdtemp(prefix="skyfold-bench-star-")
    t0 = time.perf_counter()
    run_etl(spark, sf_dir, out_dir=out_dir, full_refresh=True)
    times["etl"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()   # the next night: incremental ticket extract, month-scoped upserts
    run_etl(spark, sf_dir, out_dir=out_dir)
    times["etl_incremental"] = round(time.perf_counter() - t0, 3)

    for name in names:
        job = QUERIES[name][0]
        t0 = time.perf_counter()
        job(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus,
                      "warmup_sec": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
