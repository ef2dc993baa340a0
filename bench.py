"""Time the dataset queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "fx_raw fx_parsed fx_quarantine fx_audit mcc_ingest mcc_quarantine mcc_audit sanctions_ingest sanctions_quarantine "
    "sanctions_audit txn_ingest txn_quarantine txn_clean txn_audit txn_silver txn_silver_stream txn_high_risk "
    "txn_silver_quarantine txn_silver_audit fx_silver fx_pivot fx_silver_quarantine fx_silver_audit daily_risk_summary "
    "daily_anomaly_flags daily_fx_exposure daily_risk_audit aml_report capital_exposure regulatory_log regulatory_audit "
    "dedupe_stream user_features training_set fraud_scores"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        # Every column of every row is produced; nothing is collected or stored.
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
