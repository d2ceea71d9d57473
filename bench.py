"""Times the headline queries: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores; names
as arguments choose the queries. Each is run once to warm up, then BENCH_RUNS times (default 1), the median counts. A query
that fails is told in `failed` and does not stop the others."""

import json
import os
import statistics
import sys
import time

from meterloom.plans.queries import QUERIES
from meterloom.session import local_session

HEADLINE = ["slots_of_events", "slots_final", "requests_with_costs", "totals_5m_of_all_scans", "requests_of_transcripts", "telemetry_of_batches",
            "turns_of_sessions", "readings_classified", "repeats_dropped", "windows_5h", "steps_5h", "gaps_between_windows", "budgets_5h",
            "windows_per_week", "plan_summary", "split_week_by_project", "split_totals", "latest_reading", "slots_recounted", "price_errors",
            "no_window_runs", "payloads_of_all_dated", "median_price_per_flag", "revenue_by_month_and_segment", "orders_reconciled"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", **{"spark.sql.shuffle.partitions": os.environ.get("BENCH_CPUS", "8")})
    times, failed = {}, {}
    for name in names:
        taken = []
        try:
            for i in range(runs + 1):
                start = time.time()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    taken.append(time.time() - start)
            times[name] = round(statistics.median(taken), 3)
        except Exception as error:
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    print(json.dumps({"metric": "headline queries, total seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "failed": failed,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
