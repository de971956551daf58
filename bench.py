"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "daily_login_aggregates", "login_aggregates_backfill", "unified_events", "notif_login", "notif_message",
    "credit_check", "credit_balances", "ttl_expired", "move_saga", "download_outcomes", "delete_outcomes",
    "active_files", "olap_unified_dedup", "visible_notifications", "history_top20", "latest_notification",
    "request_outcomes", "json_contract", "frame_check", "received_from_objects", "notification_text", "metric_rate",
    "error_ratio", "histogram_quantile", "alert_for", "metric_absent", "saga_funnel", "metric_rollup_10s",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from eventmart.plans.queries import QUERIES
    from eventmart.session import create_session

    spark = create_session("bench", None, {}, **{
        "spark.master": f"local[{cpus}]", "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        # small tables: keep shuffles on all cores instead of merging them down to one task
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(HEADLINE[0])  # starts the engine
    seconds = {name: round(min(run(name) for _ in range(2)), 3) for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
