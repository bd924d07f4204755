"""Time the headline queries and print one JSON line.

The sample tables are one row group each, so one task would read them whole.
The Bronze feeds are therefore landed first, in several files as an ingest
leaves them, and every query runs from there: Bronze to result.  The landing
is timed and part of the total.  Reports on logs and on the inventory read stored
tables, which the warm-up writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import Layers, layer_queries  # noqa: E402
from lodestrata.session import build_session, fresh_dir  # noqa: E402
from lodestrata.sources.tables import Lake  # noqa: E402

HEADLINES = [
    "fact_sales", "dim_customers", "dim_products", "fact_daily_revenue", "fact_payment_summary",
    "fact_shipment_performance", "profile_table", "rfm_scores", "iqr_outliers", "gate_gold",
    "dq_suite", "rpt_daily_revenue", "schema_tests", "tag_validate", "governance_kpis",
    "anomaly_flags", "medallion_run",
]
WARM_UPS, RUNS = 1, 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = layer_queries()
    names = sys.argv[1:] or HEADLINES
    seconds = {}
    lake, given = Lake(spark, fresh_dir(spark, "bench")), Layers(spark, sf_dir)
    began = time.perf_counter()
    landed = {
        name: lake.publish(given.bronze[name].repartition(int(cpus)), "bronze", name)
        for name in given.bronze
    }
    landing = round(time.perf_counter() - began, 3)
    for name in names:
        taken = []
        for _ in range(WARM_UPS + RUNS):
            began = time.perf_counter()
            queries[name](Layers(spark, sf_dir, landed)).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[WARM_UPS:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_median_wall_clock",
        "value": round(sum(seconds.values()) + landing, 3),
        "unit": "sec",
        "queries": seconds,
        "land_bronze_sec": landing,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
