"""Time the headline queries; print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of threads.  Each
query runs once to warm up and then three times; its median counts.  The
result is written to the noop sink, so all rows are computed and none are
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from amihan.catalog.queries import REGISTRY  # noqa: E402
from amihan.session import local_session  # noqa: E402

HEADLINE = (
    "stg_transactions",
    "int_ctr_candidates",
    "int_structuring_detection",
    "int_layering_detection",
    "layering_net_intent",
    "int_kyc_health",
    "int_customer_risk_rating",
    "signal_fatf",
    "int_str_candidates",
    "signal_dormancy",
    "signal_smurfing",
    "fct_covered_transactions",
    "fct_suspicious_transactions",
    "fct_customer_compliance",
    "fct_branch_compliance_summary",
    "dq_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "amihan-bench", shuffle_partitions=int(cpus))

    def once(key: str) -> float:
        start = time.perf_counter()
        REGISTRY[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for key in HEADLINE:
        once(key)
        seconds[key] = round(statistics.median(once(key) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
