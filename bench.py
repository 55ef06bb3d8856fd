"""Wall time of the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; its median counts.
BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma separated) change the set-up.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from scorespark.session import build_session  # noqa: E402

HEADLINES = (
    "risk_labels rfms customer_aggregates customer_aggregates_joined label_transactions "
    "feature_table standardize label_encode parse_ids date_features "
    "woe_numeric woe_categorical iv_numeric quantile_bins categorical_bin_columns woe_transform "
    "describe_numeric correlation_long cardinality top_categories account_samples "
    "outliers_value histogram_linear quantiles accounts_per_customer channel_drift "
    "classification_metrics kmeans_2d batch_scoring"
).split()
TRAINING = ("train_models",)


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in chosen or [*HEADLINES, *TRAINING]:
        first = timed(spark, name, folder)
        repeats = 0 if name in TRAINING else runs
        seconds[name] = round(statistics.median([timed(spark, name, folder) for _ in range(repeats)] or [first]), 3)
        print(f"{name} {seconds[name]} (first {first:.2f})", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cpus": cpus,
                "memory": spark.conf.get("spark.driver.memory", "default"),
                "python": platform.python_version(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
