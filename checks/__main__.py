"""python -m checks [sf_dir] [query ...]: compare registered queries with their SQL."""

import os
import sys

from pyspark.sql import SparkSession

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import REGISTRY

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(REGISTRY)
cpus = os.environ.get("BENCH_CPUS", "8")
spark = (
    SparkSession.builder.master(f"local[{cpus}]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "8g")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
bad = 0
for name in names:
    try:
        r = compare(spark, con, sf_dir, name, REGISTRY[name], ORACLES.get(name))
    except Exception as e:  # noqa: BLE001 - report and go on with the next query
        r = {"name": name, "ok": False, "rows": -1, "sec": 0, "why": f"{type(e).__name__}: {str(e)[:1500]}"}
    bad += not r["ok"]
    print(f"{'ok ' if r['ok'] else 'BAD'} {r['name']:32} {r['rows']:>8} rows {r['sec']:>6}s {r['why']}", flush=True)
print(f"{len(names) - bad}/{len(names)} ok")
