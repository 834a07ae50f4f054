"""Measure how the hot-key plans spread a skewed key over tasks.

Skew is injected into the stand-in tables: one patient receives a third of
all admissions, and one admission a third of all labs. Each operator then
runs twice, with the hot-key path off (threshold above any key) and on.
From Spark's event log, written to a fresh scratch folder, the script reports
per run its bottleneck stage: the largest number of shuffle records any single
task read, the stage's total and its task count. AQE partition coalescing and
size-based broadcasts are off, so the planned partitions stay visible and
joins shuffle as they would on tables too big to broadcast. Results are
checked to be equal in both runs.

Usage: python scripts/skew_experiment.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from wardlens.operators.features import lab_window  # noqa: E402
from wardlens.operators.sequences import readmission_target  # noqa: E402
from wardlens.session import get_spark  # noqa: E402
from wardlens.sources import standin  # noqa: E402

OFF = 10**12


def _skewed(spark, sf_dir):
    adm = standin.admissions(spark, sf_dir)
    labs = standin.labevents(spark, sf_dir)
    hot_subject = adm.agg(F.min("subject_id")).first()[0]
    hot_hadm = adm.agg(F.min("hadm_id")).first()[0]
    adm = adm.withColumn("subject_id", F.when(F.col("hadm_id") % 3 == 0, F.lit(hot_subject))
                         .otherwise(F.col("subject_id")))
    labs = labs.withColumn("hadm_id", F.when(F.hash("hadm_id", "charttime") % 3 == 0, F.lit(hot_hadm))
                           .otherwise(F.col("hadm_id")))
    return adm, labs


def _task_stats(log_dir):
    """description -> bottleneck stage: (max shuffle records of one task, stage total, tasks)."""
    stage_desc, stages = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    sid = ev.get("Stage ID")
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    mx, tot, cnt = stages.get(sid, (0, 0, 0))
                    stages[sid] = (max(mx, n), tot + n, cnt + 1)
    out = {}
    for sid, st in stages.items():
        desc = stage_desc.get(sid)
        if desc and st[0] > out.get(desc, (0, 0, 0))[0]:
            out[desc] = st
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="wardlens-eventlog-")
    spark = get_spark("local[8]", app_name="wardlens-skew", shuffle_partitions=16,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                             "spark.eventLog.compress": "false",
                             # keep post-shuffle partitions as planned, so the split is visible
                             "spark.sql.adaptive.coalescePartitions.enabled": "false",
                             # behave as with tables too big to broadcast (sort-merge joins)
                             "spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    adm, labs = _skewed(spark, sf_dir)
    n_adm = adm.count()
    runs = {
        "readmission_target": lambda t: readmission_target(adm, hot_threshold=t, sort=False),
        "lab_window": lambda t: lab_window(labs, adm, hot_threshold=t),
    }
    hot_threshold = max(1000, n_adm // 100)
    results = {}
    for name, build in runs.items():
        rows = {}
        for mode, t in (("plain", OFF), ("hot", hot_threshold)):
            desc = f"{name}:{mode}"
            spark.sparkContext.setJobDescription(desc)
            t0 = time.perf_counter()
            rows[mode] = sorted(map(tuple, build(t).collect()), key=repr)
            results[desc] = {"sec": round(time.perf_counter() - t0, 2)}
            spark.sparkContext.setJobDescription(None)
        results[f"{name}:equal"] = rows["plain"] == rows["hot"]
    spark.stop()
    for desc, (mx, tot, cnt) in _task_stats(log_dir).items():
        if desc in results:
            results[desc].update(bottleneck_max_task_records=mx, bottleneck_stage_records=tot,
                                 bottleneck_stage_tasks=cnt)
    print(json.dumps({"sf_dir": sf_dir, "admissions": n_adm, "hot_threshold": hot_threshold,
                      "results": results}, indent=1))


if __name__ == "__main__":
    main()
