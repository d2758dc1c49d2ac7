"""Time the headline queries and print one JSON line. Sizes: $BENCH_SF_DIR, $BENCH_CPUS."""

from __future__ import annotations

import json
import os
import re
import time

from workload.check import session
from workload.queries import QUERIES

HEADLINE = (
    "territory_burning_cost prep_policies segment_exposure feature_matrix feature_matrix_sketched decile_boundaries "
    "dataset_read glm_predictions glm_one_way cv_mean_and_std freq_sev_product gbt_predictions prediction_errors "
    "double_lift lorenz_points lorenz_gini model_comparison exposure_histogram tree_attributions_add_up "
    "xml_policy_roundtrip source_normalise dictionary_columns"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = session(cpus)
    QUERIES["territory_burning_cost"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
