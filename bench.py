"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from usagetide.registry.queries import bind  # noqa: E402
from usagetide.session import build_session  # noqa: E402

HEADLINE = [
    "stg_daily_usage",
    "int_usage_velocity",
    "int_friction_flags",
    "int_cohort_health",
    "fct_cohort_churn",
    "fct_account_features",
    "cohort_heatmap",
    "pre_churn_curve",
    "cumulative_churn",
    "errors_by_onboarding_day",
    "km_curve_hard",
    "logrank_test_soft",
    "propensity_summary",
    "caliper_match",
    "balance_table",
    "roc_auc",
    "scored_accounts",
    "counterfactual_scenarios",
    "portfolio_kpis",
    "account_rolling",
    "quality_report",
]
# Timed and listed too; the total stays that of the headline queries, so that runs compare.
FURTHER = [
    "propensity_score",
    "persist_model",
    "quality_report_observed",
    "refresh_velocity",
    "logrank_test_matched_soft",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    bind("read_source")(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    chosen = sys.argv[1:] or [*HEADLINE, *FURTHER]
    for name in chosen:
        started = time.perf_counter()
        bind(name)(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(t for n, t in times.items() if sys.argv[1:] or n in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "total_with_further": round(sum(times.values()), 3),
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
