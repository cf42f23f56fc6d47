"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of tables), BENCH_CPUS (local threads).
Each query is planned and run to the end once, into a sink that keeps nothing,
after one small query has started the session's threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from txnguard.catalog.queries import QUERIES
from txnguard.session import build_session

HEADLINE = (
    "dataset_summary",
    "clean_transactions",
    "drop_reasons",
    "prepared_features",
    "gold_table",
    "kpis",
    "alerts_by_source",
    "alert_payload",
    "recent_alerts_top50",
    "fraud_by_type",
    "amount_quantiles_exact",
    "blacklist_join_flags",
    "blacklist_profile",
    "hash_split_counts",
    "bounded_stratified_sample",
    "classification_metrics",
    "auc",
    "roc_curve",
    "csv_clean_transactions",
    "json_roundtrip",
    "stream_gold",
    "stream_alerts",
    "stream_kpi_counters",
    "stream_window_kpis",
    "stream_dedup",
    "train_compare",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "txnguard-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, folder).collect()

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
