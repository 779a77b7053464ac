"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of local threads. Every query runs
to the end (all rows are produced, none are collected). The list is run ``BENCH_REPEATS`` times as a
whole and the best run of each query counts, so that a cold JVM is not what is measured.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordertrail.plans import registered  # noqa: E402
from ordertrail.session import drop_scratch, get_session  # noqa: E402

HEADLINE = [
    "funnel_conversion", "revenue_leakage", "revenue_by_status", "cancellation_by_state",
    "cancellation_by_category_top10", "monthly_cohort", "delivery_delay_by_state",
    "delivery_delay_by_state_top10", "fact_orders", "dim_payments", "dim_customers", "dim_products",
    "fk_filter", "rfm", "rfm_describe", "zscore", "silhouette", "churn_base", "churn_label",
    "customer_features", "cohort_retention", "roc_auc", "fk_report", "revenue_at_risk", "export_all",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    # start the engine before the clock does
    spark.read.parquet(f"{folder}/nation.parquet").count()
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(repeats):
        for name in names:
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - start)
    times = {name: round(min(taken), 3) for name, taken in runs.items()}
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
