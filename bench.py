"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from fleetgauge.plans import catalog
from fleetgauge.session import build_session

HEADLINE = [
    "k8_fleet_schedule", "w5_feature_transformer", "w7_last_rows", "x1_holdout_scaled",
    "a4_spearman", "a11_quantiles", "m8_classification_bundle", "k3_threshold_sweep",
    "k5_lead_time_cdf", "q3_quality_totals", "d1_drift_ks_wide", "y8_survival_rows",
    "st2_stream_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session("bench", cores=cores)
    catalog.QUERIES["a12_counts"](spark, sf_dir).collect()  # start-up is not part of any query
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
