"""Largest per-task shuffle read of a plain LEAD window vs the time-sliced lead.

usage: python tools/skew_tasks.py [rows]
Builds a skewed input (one key holds half the rows), runs both variants with
Spark's event log written to a fresh scratch folder, and prints, for each, the
most shuffle records any single task read. Spark's UI stays off.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from starflow.operators.star import next_in_key  # noqa: E402
from starflow.session import get_session  # noqa: E402


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    logs = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = get_session("local[8]", shuffle_partitions=32,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                               "spark.eventLog.compress": "false",
                               # show the split itself, not AQE merging small partitions
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = (spark.range(rows)
          .select(F.when(F.col("id") % 2 == 0, F.lit("HOT"))
                   .otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))).alias("k"),
                  (F.lit(1_700_000_000) + F.col("id")).cast("timestamp").alias("ts")))
    for name, safe in (("plain window", False), ("time-sliced", True)):
        spark.sparkContext.setJobGroup(name, name)
        next_in_key(df, "k", "ts", "nxt", skew_safe=safe).write.format("noop").mode("overwrite").save()
    spark.stop()
    best: dict[str, int] = {}
    per_stage: dict[tuple, int] = {}
    names: dict[int, str] = {}
    group_of_job: dict[int, str] = {}
    stage_group: dict[int, str] = {}
    files = [f for f in glob.glob(os.path.join(logs, "**", "*"), recursive=True)
             if os.path.isfile(f) and "appstatus" not in os.path.basename(f)]
    for path in sorted(files):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    group_of_job[ev["Job ID"]] = g
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerStageCompleted":
                    info = ev.get("Stage Info") or {}
                    names[info.get("Stage ID")] = (info.get("Stage Name") or "")[:60]
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if g:
                        best[g] = max(best.get(g, 0), n)
                        key = (g, ev.get("Stage ID"))
                        per_stage[key] = max(per_stage.get(key, 0), n)
    for g, n in best.items():
        print(f"{g:14s} largest task shuffle read: {n:,} records of {rows:,}")
    if os.environ.get("SKEW_STAGES"):
        for (g, sid), n in sorted(per_stage.items(), key=lambda x: (str(x[0][0]), x[0][1])):
            print(f"   {g:14s} stage {sid} ({names.get(sid, '')}): {n:,}")


if __name__ == "__main__":
    main()
