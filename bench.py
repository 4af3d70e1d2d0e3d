"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Every query runs over its whole
input and its full result is produced by a ``noop`` write; eager parts (staging, fits) are included.
"""

from __future__ import annotations

import json
import os
import time

from checks.registry import QUERIES
from voltweave import build_session

HEADLINES = [
    "e1_daily_mean",
    "d2_join_daily",
    "q_daily_measures",
    "e2_daily_median",
    "k2_geo_cluster_ward",
    "q_site_targets",
    "q_site_distances",
    "m2_initial_split",
    "m3_vfold",
    "l1_correlation_p_values",
    "l2_histogram",
    "j10_transformed_readings",
    "j16_feature_steps",
    "j16_scaled_steps",
    "f8_trailing_roll",
    "n6_fit_resamples",
    "n13_fit_all_and_submit",
    "n3_boosted_trees",
]


def main() -> None:
    import checks.catalog  # noqa: F401

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
