"""Times the headline queries and prints one JSON line.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[BENCH_CPUS]``. Each query is
evaluated in full through the noop sink; the time includes planning and driver-side steps.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskframe.queries import catalog  # noqa: E402
from riskframe.session import build_session  # noqa: E402

HEADLINE = (
    "left_join_identity",
    "key_coverage",
    "orphan_keys",
    "null_profile",
    "temporal_split",
    "five_way_split",
    "stratified_split",
    "systematic_sample",
    "split_metrics",
    "classification_metrics",
    "volume_metrics",
    "threshold_min_cost",
    "model_differences",
    "fitted_medians",
    "prepared_rows",
    "drift_volume_profile",
    "drift_checks",
    "fingerprint_unordered",
    "fingerprint_ordered",
    "record_issues",
    "flagged_rate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "riskframe-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()
    timings = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
