"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holdfast.catalog.queries import QUERIES
from holdfast.session import build_session, owned_tables, release_stored

HEADLINE = (
    "src_window_27m",
    "activity",
    "win_gap_months",
    "features",
    "label_training",
    "union_tagged",
    "cap_floor",
    "balance_classes",
    "latest_per_key",
    "client_churn",
    "share_of_client",
    "client_list",
    "client_targets",
    "rank_clients",
    "carry_over",
    "assign_quota",
    "allocate_shares",
    "risk_view",
    "row_number",
    "sink_roundtrip",
    "model_calibrate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JVM's code generation and the scans.
    QUERIES["activity"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        with owned_tables() as stored:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release_stored(spark, stored)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
