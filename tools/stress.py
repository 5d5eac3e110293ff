"""Skewed stress run: a hot arrival date, a hot user and a hot product.

    python tools/stress.py [rows] [dates]

One arrival date gets a third of all rows; a third of all rows (spread over the
dates) belong to user 1 and product 1. Bronze is generated, then one backfill
builds Silver and Gold for every date and the mart is loaded. The Spark event
log goes to the scratch folder; per stage, the longest task is compared with the
median task, which shows whether a hot group landed on one task.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(rows: int, n_dates: int) -> dict:
    import tempfile
    from pyspark.sql import functions as F
    from daybook.functions import draw
    from daybook.operators import generate
    from daybook.plans import pipeline
    from daybook.session import get_session, local_path, scratch_dir
    from daybook.sources import bronze

    logdir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = get_session(app="daybook-stress", master="local[8]", shuffle_partitions=64,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                               "spark.eventLog.compress": "false",
                               "spark.eventLog.rolling.enabled": "false",
                               "spark.driver.memory": "16g"})
    paths = pipeline.Paths.under(scratch_dir(spark, "stress"))
    dates = [f"2026-02-{d:02d}" for d in range(1, n_dates + 1)]
    hot = rows // 3
    rest = (rows - hot) // (n_dates - 1)
    t0 = time.perf_counter()
    for i, d in enumerate(dates):
        n = hot if i == 0 else rest
        ev = generate.events_for_ids(spark.range(0, n, 1, max(8, n // 500_000)), d)
        pick = draw(d, "hot", F.monotonically_increasing_id()) % 3 == 0
        ev = ev.withColumn("user_id", F.when(pick, F.lit(1)).otherwise(F.col("user_id"))) \
               .withColumn("product_id", F.when(pick, F.lit(1)).otherwise(F.col("product_id")))
        bronze.write_bronze(ev, paths.bronze)
    t1 = time.perf_counter()
    res = pipeline.run_dates(spark, paths, dates)
    t2 = time.perf_counter()
    pipeline.load(spark, paths, dates)
    t3 = time.perf_counter()
    gold = pipeline.gold_for(spark, paths).orderBy("process_date").collect()
    total_rows = hot + rest * (n_dates - 1)
    app_id = spark.sparkContext.applicationId
    spark.stop()

    stages: dict[int, list[float]] = {}
    names: dict[int, str] = {}
    for f in glob.glob(os.path.join(local_path(logdir), "**", "*"), recursive=True):
        if os.path.isdir(f) or os.path.basename(f).startswith("appstatus"):
            continue
        with open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    stages.setdefault(ev["Stage ID"], []).append(
                        (info["Finish Time"] - info["Launch Time"]) / 1000)
                elif ev.get("Event") == "SparkListenerStageCompleted":
                    names[ev["Stage Info"]["Stage ID"]] = ev["Stage Info"]["Stage Name"][:40]
    skew = []
    for sid, ts in sorted(stages.items()):
        if len(ts) >= 4:
            med = statistics.median(ts)
            skew.append({"stage": sid, "name": names.get(sid, ""), "tasks": len(ts),
                         "max_s": round(max(ts), 2), "median_s": round(med, 2)})
    return {
        "rows": total_rows, "dates": n_dates, "hot_date_rows": hot,
        "generate_s": round(t1 - t0, 2), "bronze_to_gold_s": round(t2 - t1, 2),
        "load_s": round(t3 - t2, 2),
        "rows_per_s": round(total_rows / (t2 - t1)),
        "gold_rows": len(gold), "hot_date_dau": gold[0]["daily_active_users"],
        "hot_date_top_product": gold[0]["top_product_id"],
        "missing": res.missing, "app": app_id, "stages": skew,
    }


if __name__ == "__main__":
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 9_000_000
    n_dates = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    out = main(rows, n_dates)
    stages = out.pop("stages")
    print(json.dumps(out))
    for s in stages:
        print(json.dumps(s))
