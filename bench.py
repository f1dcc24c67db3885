"""Times the headline queries and prints one JSON line.

``build_layers`` is the whole way from the given tables to stored gold tables: bronze,
silver, keys, dimensions and fact. The first build in the fresh JVM is given as
``cold_build``, the second is the time that counts. Each report then runs once to warm
up and twice for the time, of which the better counts, with its full result computed
and thrown away (no-op sink). ``value`` is the sum of the times under ``queries``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardlake import registry  # noqa: E402
from cardlake.plans.lakehouse import build_sample, lakehouse  # noqa: E402
from cardlake.session import local_session  # noqa: E402

HEADLINE = (
    "silver_reconciliation", "gold_validation", "analytics_validation", "bi_controls",
    "platform_kpis", "method_summary", "annual_summary", "view_reconciliation",
    "kpis_filtered", "annual_filtered", "method_filtered", "fraud_by_method",
    "fraud_by_year", "top_states", "top_categories", "latest_transactions",
    "kpi_controls", "yoy_by_year", "rate_bps_by_year", "executive_summary",
    "monthly_trend", "fraud_error_trend", "method_mix", "error_breakdown",
    "portfolio_selected", "fraud_by_category", "top_fraud_merchants", "exposure_concentration",
    "merchant_risk", "merchant_vs_portfolio", "evidence_ledger",
    "missing_profile", "distinct_profile", "value_counts", "duplicate_rows",
)


def run(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "cardlake-bench")
    spark.range(1000).selectExpr("sum(id)").collect()

    times = {}
    start = time.perf_counter()
    lakehouse(spark, sf_dir)
    cold = time.perf_counter() - start
    start = time.perf_counter()
    build_sample(spark, sf_dir)
    times["build_layers"] = time.perf_counter() - start

    queries = registry.queries()
    for name in HEADLINE:
        run(queries[name], spark, sf_dir)
        times[name] = min(run(queries[name], spark, sf_dir) for _ in range(2))
    print(json.dumps({
        "metric": "total seconds of layer build and warm reports",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "cold_build": round(cold, 3),
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
