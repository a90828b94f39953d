"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data (default sf0.1), BENCH_CPUS the local cores (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

QUERIES = [
    "crosstab",
    "crosstab_six_variables",
    "conditional_rate",
    "label_rates",
    "unemployment_rate",
    "direct_estimates",
    "trim_grid",
    "gvf_smooth",
    "fh_normal_fitted_grid",
    "fh_eblup_reml",
    "fh_binomial",
    "mrp_estimate_by_area",
    "mrp_levels",
    "multidim_poverty_draws",
    "random_intercept_model",
    "multinomial_mixed_model",
    "summarise_draws",
    "zonal_sum",
]


def main() -> None:
    from arealis.plans import registry
    from arealis.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    wanted = sys.argv[1:] or QUERIES
    # start the workers and the scan path before the clock runs
    registry.QUERIES["direct_estimates_student"](spark, sf_dir.replace("sf0.1", "sf0.001")).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        start = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
