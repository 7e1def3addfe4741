"""Write PLANS.md: the physical plan of the headline queries at one scale.

    python tools/plans.py [sf_dir]

Plans are taken after the eager steps a query runs (checkpointed batches are
``Scan ExistingRDD``); each is trimmed to operator lines plus pushed filters
and read schemas.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = ["latest_change_ties", "latest_change_one", "merge_strict", "merge_strict_shuffle",
            "merge_clustered", "snapshot_diff", "conform_good", "landing_roundtrip"]
KEEP = re.compile(r"^(\s*[+:-]|\s*\*|\(\d+\) |\s*(PushedFilters|ReadSchema|Join type|Bucketed|"
                  r"Arguments: hashpartitioning))")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = [ln.rstrip() for ln in buf.getvalue().splitlines() if KEEP.match(ln)]
    return "\n".join(ln[:180] for ln in lines)


def clustered_merge_step(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.operators.latest import latest_one
    from tidemark.operators.merge import merge
    from tidemark.session import scratch_path
    from tidemark.sources import feeds
    from tidemark.sources.feeds import FEED_CONTRACT
    from tidemark.sources.table import VersionedTable

    t = VersionedTable(spark, scratch_path(spark, "plans_clustered"),
                       cluster_keys=FEED_CONTRACT.key_cols, cluster_buckets=16)
    t.write(feeds.customer_target(spark, sf_dir).withColumn("is_deleted", F.lit(False)))
    batch = latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)
    return merge(t.read(), batch, FEED_CONTRACT, strategy="shuffle").table


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "", f"`python tools/plans.py {sf_dir}`, local[8], AQE on "
           "(plans shown before AQE re-optimisation).", ""]
    for name in HEADLINE:
        out += [f"## {name}", "", QUERIES[name].__doc__.strip().split("\n")[0], "", "```",
                plan_text(QUERIES[name](spark, sf_dir)), "```", ""]
    out += ["## merge step on a key-bucketed target", "",
            "The merge inside `merge_clustered`: the target is read bucket by bucket "
            "(no Exchange), only the batch is shuffled.", "", "```",
            plan_text(clustered_merge_step(spark, sf_dir)), "```", ""]
    Path(__file__).resolve().parents[1].joinpath("PLANS.md").write_text("\n".join(out))


if __name__ == "__main__":
    main()
