"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query is
built and fully run (noop sink) after one untimed warm-up of the session (JVM and Python workers). The best of
BENCH_REPEATS runs counts; a query that took over four seconds is run once.
"""

from __future__ import annotations

import json
import os
import time

from specloom.catalog import QUERIES
from specloom.session import build_session

HEADLINE = [
    "brand_summary", "annual_launches", "chipset_popularity", "network_technology", "ppi_trend", "top_expensive_products",
    "best_per_top_brands", "top_per_period", "recommend_filtered", "correlation_matrix", "quantitative_distributions",
    "quartiles", "group_summary", "full_star", "clean_price_eur", "clean_dimensions", "audit_frame", "expand_configs",
    "override_price", "clean_chain", "impute_cascade", "lookup_key", "fact_signatures", "fact_lookup_ids", "assign_ids",
    "check_rules", "check_unique", "result_difference", "flatten_json", "page_links", "mann_whitney_stat", "welch_stat",
    "ht_price_by_brand_and_size", "price_model_os", "price_model_full", "stepwise_path", "cooks_top", "q05", "q10", "q15", "e06",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    for warm in ("brand_summary", "page_next_link"):  # the JVM, and the Python workers
        QUERIES[warm](spark, root).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
            if took > 4:
                break
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
