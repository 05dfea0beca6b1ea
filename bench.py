"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores),
BENCH_QUERIES (comma-separated names, default the headline list), BENCH_RUNS (default 2).
Every query runs once to warm up; the best of the following runs counts. Results go to the
no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripledger.plans.queries import QUERIES  # noqa: E402
from tripledger.settings import SESSION_CONF  # noqa: E402

HEADLINE = (
    "load_topics_union", "schema_conformance",
    "recon_detail", "recon_detail_bank_key", "recon_summary", "recon_duplicates", "recon_latest",
    "user_features", "user_features_volume", "user_features_diversity", "user_features_windowed",
    "feature_summary",
    "txn_validate", "fraud_rules", "fraud_rules_hot_users", "fraud_alert_text", "fraud_text_sample",
    "burst_detect", "burst_detect_hot_users",
    "dedupe_latest", "upsert_features", "upsert_reconciled",
    "land_topics", "stream_fraud_rules", "stream_burst",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for name, value in SESSION_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(min(once(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of best times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
