"""Largest task input with one key holding a third of all rows.

    python tools/skew.py [sf_dir]

Runs the latest-change forms over a lineitem feed where every row with return
flag N is re-keyed to one key, with Spark's event log written to a fresh
scratch folder, then reads the log: for each form, the most shuffle records
any single task read.  The window form (the reference job's formulation) is
run only as the comparison point.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.latest import latest_one, latest_with_ties  # noqa: E402
from tidemark.sources import feeds  # noqa: E402
from tidemark.sources.feeds import LINEITEM_CONTRACT  # noqa: E402

sys.path.insert(0, str(Path(__file__).resolve().parent))
from measure import window_ties  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tidemark-evlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").appName("tidemark-skew")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             # one task per hash partition, so the largest task shows skew,
             # not AQE merging small partitions
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.eventLog.rolling.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    hot = lambda: feeds.lineitem_feed(spark, sf_dir).withColumn(
        "record_id", F.when(F.col("op") == "D", F.lit(-1)).otherwise(F.col("record_id")))
    forms = {
        "window_max (reference form)": lambda: window_ties(hot().drop("seq"), LINEITEM_CONTRACT),
        "latest_with_ties (agg + join)": lambda: latest_with_ties(hot().drop("seq"), LINEITEM_CONTRACT),
        "latest_one (max_by)": lambda: latest_one(hot(), LINEITEM_CONTRACT),
        "latest_one (wide rows)": lambda: latest_one(hot(), LINEITEM_CONTRACT, wide=True),
    }
    total = hot().count()
    hot_rows = hot().where("record_id = -1").count()
    for name, fn in forms.items():
        spark.sparkContext.setJobDescription(name)  # eager steps (checkpoints) included
        fn().write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_job, job_desc = {}, {}
    max_read = defaultdict(int)
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if Path(p).is_file()]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    job_desc[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    sid = ev["Stage ID"]
                    max_read[sid] = max(max_read[sid], m.get("Total Records Read", 0))
    per_form = defaultdict(int)
    for sid, n in max_read.items():
        desc = job_desc.get(stage_job.get(sid))
        if desc in forms:
            per_form[desc] = max(per_form[desc], n)
    print(json.dumps({"rows": total, "hot_key_rows": hot_rows,
                      "max_shuffle_records_read_by_one_task": dict(per_form)}, indent=1))


if __name__ == "__main__":
    main()
