"""Measure sessionization when one user holds a third of all events.

Usage: python tools/skew_demo.py [batches] [cores]

Builds batches x 50,000 synthetic events (pure spark.range expressions),
moves every third event to user 1, lands them as parquet in a scratch folder
under the shared root, then times (on that scan) the plain one-window plan
against the split plan (min_slice_rows=1 so the threshold is N / 2P), best
of two after warming both up, and checks that both give the same result.

Spark's event log (written to a scratch folder) gives, per plan, the
largest task: most shuffle records read and longest run time. Prints one
JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from saasmart.operators.sessionize import sessionize, sessionize_plain  # noqa: E402
from saasmart.plans.staging import stg_events  # noqa: E402
from saasmart.session import scratch_dir  # noqa: E402
from saasmart.sources import synth  # noqa: E402


def largest_tasks(log_dir: str) -> dict[str, dict[str, float]]:
    """Per job group: max shuffle records read by one task, max task seconds."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, float]] = defaultdict(lambda: {"records": 0, "seconds": 0.0})
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    if not group:
                        continue
                    info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                    records = (metrics.get("Shuffle Read Metrics") or {}).get(
                        "Total Records Read", 0)
                    secs = (info["Finish Time"] - info["Launch Time"]) / 1000.0
                    out[group]["records"] = max(out[group]["records"], records)
                    out[group]["seconds"] = max(out[group]["seconds"], round(secs, 2))
    return dict(out)


def main() -> None:
    batches = int(sys.argv[1]) if len(sys.argv) > 1 else 60
    cores = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    log_dir = tempfile.mkdtemp(prefix="skew-demo-eventlog-")  # local tool run only
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("skew-demo")
             .config("spark.sql.shuffle.partitions", str(cores))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.rolling.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ev = stg_events(synth.events(spark, list(range(batches))).drop("batch"))
    path = scratch_dir(spark, "skew-demo") + "/events"
    (ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1))
                   .otherwise(F.col("user_id")))
     .write.parquet(path))
    skewed = spark.read.parquet(path)  # measured on a parquet scan, like real inputs

    def timed(df, group):
        spark.sparkContext.setJobGroup(group, group)
        t0 = time.perf_counter()
        digest = df.agg(F.sum(F.pmod(F.xxhash64("event_id", "session_number",
                                                "is_new_session"), F.lit(1_000_003)))
                        .alias("h"), F.count("*").alias("n")).first()
        return time.perf_counter() - t0, tuple(digest)

    def plain():
        return sessionize_plain(skewed)

    def split():
        spark.sparkContext.setJobGroup("split", "split")
        return sessionize(skewed, min_slice_rows=1)

    timed(plain(), "warmup")  # warm-up of both plans (code generation, JIT)
    timed(sessionize(skewed, min_slice_rows=1), "warmup")
    runs = [(timed(plain(), "plain"), timed(split(), "split")) for _ in range(2)]
    plain_s = min(r[0][0] for r in runs)
    split_s = min(r[1][0] for r in runs)
    plain_d, split_d = runs[0][0][1], runs[0][1][1]
    hot_rows = skewed.where("user_id = 1").count()
    spark.stop()  # flushes the event log
    tasks = largest_tasks(log_dir)
    print(json.dumps({
        "rows": batches * 50000, "hot_user_rows": hot_rows, "cores": cores,
        "plain_s": round(plain_s, 2), "split_s": round(split_s, 2),
        "same_result": plain_d == split_d,
        "largest_task": {g: tasks.get(g) for g in ("plain", "split")},
    }))


if __name__ == "__main__":
    main()
