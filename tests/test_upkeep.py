"""Digest tree, several writers, low-water mark, one-pass apply and its log,
schema versions, file reports, literal rows."""

import contextlib
import datetime as dt
import io
import json
import random
import subprocess
import sys
import tempfile
import threading
from pathlib import Path

import pytest
from conftest import C, rows_of
from pyspark.sql import functions as F

from tidemark.contract import ChangeContract
from tidemark.functions.expr import to_change_time_any
from tidemark.operators import apply as applying
from tidemark.operators.diff import DuplicateKeyError, NullKeyError, reconcile, reconcile_summary, snapshot_diff
from tidemark.operators.digest_tree import (DigestTree, differing_rows, reconcile_by_digest, reconcile_summary_by_digest,
                                            snapshot_diff_by_digest)
from tidemark.operators.latest import latest_one
from tidemark.operators.merge import merge
from tidemark.sources.table import ConcurrentWriteError, LiveKeyError, VersionedTable
from tidemark.streaming.upsert import upsert_batch_fn

K = ChangeContract(columns=("k", "a", "b", "d"), key_cols=("k",), ts_col="d")
SCHEMA = "k long, a string, b double, d timestamp_ntz"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# ---------------------------------------------------------------- digest tree
def pair(spark, n, change, seed=0):
    rng = random.Random(seed)
    a = {k: (rng.choice(["x", "y", None, ""]), rng.choice([0.0, 1.5, None, float("nan")]), dt.datetime(2024, 1, 1 + k % 28)) for k in range(n)}
    b = dict(a)
    for k in rng.sample(range(n), min(change, n)):
        what = rng.random()
        if what < 0.3:
            del b[k]
        elif what < 0.6:
            b[n + k] = a[k]
        else:
            b[k] = ("z", None, None)
    return [spark.createDataFrame([(k, *v) for k, v in x.items()], SCHEMA).repartition(3) for x in (a, b)]


@pytest.mark.parametrize("n, change, tree", [
    (0, 0, DigestTree()), (400, 0, DigestTree()), (400, 5, DigestTree(root_bits=3, step_bits=2)),
    (400, 400, DigestTree(root_bits=2, step_bits=3)), (900, 30, DigestTree(root_bits=4, step_bits=4, max_ranges=64)), (50, 9, DigestTree())])
def test_digest_tree_equals_the_full_join(spark, n, change, tree):
    a, b = pair(spark, n, change, seed=n + change)
    assert rows_of(reconcile_by_digest(a, b, K, tree=tree)) == rows_of(reconcile(a, b, K))
    # by their text: a NaN does not equal itself in Python
    assert repr(rows_of(snapshot_diff_by_digest(a, b, K, tree=tree))) == repr(rows_of(snapshot_diff(a, b, K)))
    assert rows_of(reconcile_summary_by_digest(a, b, K, tree=tree)) == rows_of(reconcile_summary(reconcile(a, b, K, only_mismatches=False)))


def test_digest_tree_descends_into_what_differs_only(spark):
    a, b = pair(spark, 5000, 0)
    b = b.withColumn("a", F.when(F.col("k") == 77, "changed").otherwise(F.col("a")))
    d = differing_rows(a, b, K, tree=DigestTree(root_bits=3, step_bits=3, join_share=0.001))
    assert len(d.levels) >= 3 and [x.differing for x in d.levels] == [1] * len(d.levels)
    assert all(x.ranges <= 8 for x in d.levels)
    assert d.a.count() == d.b.count() == d.levels[-1].rows[0] <= 0.02 * 5000 and d.equal_rows == 5000 - d.a.count()
    # differences everywhere: no level after the one that told so
    b = b.withColumn("b", F.lit(9.0))
    d = differing_rows(a, b, K, tree=DigestTree(root_bits=3, step_bits=3))
    assert len(d.levels) == 2 and d.a.count() == 5000


def test_equal_tables_shuffle_no_row(spark):
    a, b = pair(spark, 3000, 0)
    d = differing_rows(a, b, K)
    assert (d.rows_a, d.rows_b, d.equal_rows, d.levels[0].differing) == (3000, 3000, 3000, 0)
    assert d.a.isEmpty() and "Exchange" not in plan_of(d.a)  # nothing is left to join
    from tidemark.operators import digest_tree as dt_

    sums = plan_of(dt_._sums(dt_._hashed(a, ["k"], list(K.columns), dt_._common(a, b, list(K.columns))), 12))
    # what is exchanged is a partial aggregate
    assert sums.count("HashAggregate") >= 2 and "SortAggregate" not in sums


def test_digest_tree_types_and_keys(spark):
    a = spark.sql("SELECT k, cast(k AS int) AS a, cast(0.0 AS double) AS b, map('x', k) AS m FROM (SELECT explode(sequence(1L, 40L)) AS k)")
    b = spark.sql("SELECT cast(k AS int) AS k, k AS a, -0.0D AS b, map('x', k) AS m FROM (SELECT explode(sequence(1L, 40L)) AS k)")
    c = ChangeContract(columns=("k", "a", "b", "m"), key_cols=("k",), ts_col="m")
    assert differing_rows(a, b, c).levels[0].differing == 0
    with pytest.raises(ValueError):
        differing_rows(a, b, ChangeContract(columns=("m", "a"), key_cols=("m",), ts_col="a"))
    null = a.unionAll(spark.sql("SELECT null, 1, 1.0D, map('x', 1L)"))
    with pytest.raises(NullKeyError):
        differing_rows(null, b, c)
    twice = a.unionAll(a.where("k = 3"))
    with pytest.raises(DuplicateKeyError):
        reconcile_by_digest(twice, b, ChangeContract(columns=("k", "a", "b"), key_cols=("k",), ts_col="a"))
    # (null, 1) is not (1, null)
    x = spark.sql("SELECT 1L AS k, cast(null AS int) AS a, 1 AS b")
    y = spark.sql("SELECT 1L AS k, 1 AS a, cast(null AS int) AS b")
    assert reconcile_by_digest(x, y, ChangeContract(columns=("k", "a", "b"), key_cols=("k",), ts_col="a")).count() == 1


# ------------------------------------------------------------ several writers
def strict(spark, path, n=20, **kw):
    t = VersionedTable(spark, path, key_cols=("record_id",), ts_col="ts", **kw)
    if t.current_version() is None:
        t.write(spark.sql(f"""
            SELECT 'A' AS state, concat('t', id) AS val, id AS record_id,
                   TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts, false AS is_deleted, cast(null AS long) AS change_seq
            FROM range({n})"""))
    return t


def meet(tables, monkeypatch):
    """The first attempts of these writers publish at the same time."""
    gate = threading.Barrier(len(tables))
    for t in tables:
        first = []

        def publish(*a, own=t.publish, first=first, **k):
            if not first:
                first.append(1)
                gate.wait(60)
            return own(*a, **k)

        monkeypatch.setattr(t, "publish", publish)


def test_two_writers_lose_nothing(spark, tmp_dir, monkeypatch, changes):
    from tidemark.plans.upkeep import at_once

    path = f"{tmp_dir}/two"
    base = strict(spark, path)
    one, two, three = strict(spark, path), strict(spark, path), strict(spark, path)
    meet([one, two, three], monkeypatch)
    stream = upsert_batch_fn(three, C, discard_rejects=True, stream_id="s")
    told = []
    at_once(lambda: told.append(one.update("record_id = 1", {"val": "'one'"})),
            lambda: told.append(two.delete("record_id = 2")),
            lambda: stream(changes([("U", "A", "three", 3, 11, 1), ("I", "B", "new", 99, 11, 2)]), 0))
    assert base.versions() == [0, 1, 2, 3] and len(set(told)) == 2
    got = {r["record_id"]: r["val"] for r in base.read(visible=True).collect()}
    assert got[1] == "one" and 2 not in got and got[3] == "three" and got[99] == "new" and len(got) == 20
    # each version holds the one before it, and losers left no folder behind
    for n in base.versions():
        assert len(base._fs.glob(f"{path}/v={n}-*")) == 1
    stream(changes([("U", "A", "again", 3, 12, 9)]), 0)  # the batch is known, whatever won
    assert base.versions() == [0, 1, 2, 3]


def test_a_stale_base_is_refused(spark, tmp_dir):
    t = strict(spark, f"{tmp_dir}/stale")
    t.update("true", {"val": "'x'"})
    with pytest.raises(ConcurrentWriteError):
        t.write(t.read(0), base=0)
    assert t.versions() == [0, 1] and t.read().where("val = 'x'").count() == 20


def test_a_pointer_is_created_once(spark, tmp_dir):
    t = strict(spark, f"{tmp_dir}/once")
    p = f"{tmp_dir}/once/x.json"
    assert t._fs.create_text(p, "one") and not t._fs.create_text(p, "two")
    assert t._fs.read_text(p) == "one" and not t._fs.glob(f"{p}.*")


def test_options_of_writers_in_threads_are_restored(spark):
    from tidemark.sources.table import session_conf

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    a, b = session_conf(spark, {key: "1000"}), session_conf(spark, {key: "2000"})
    a.__enter__()
    b.__enter__()
    a.__exit__(None, None, None)
    assert spark.conf.get(key) == "2000"
    b.__exit__(None, None, None)
    assert spark.conf.get(key, None) == before


def test_insert_of_a_live_key_is_refused(spark, tmp_dir):
    t = strict(spark, f"{tmp_dir}/live")
    row = "SELECT 'B' AS state, 'new' AS val, {} AS record_id, TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts"
    with pytest.raises(LiveKeyError):
        t.insert(spark.sql(row.format("5L")))
    with pytest.raises(LiveKeyError):
        t.insert(spark.sql(row.format("50L")).unionAll(spark.sql(row.format("50L"))))
    t.delete("record_id = 5")
    t.insert(spark.sql(row.format("5L")))
    assert t.read(visible=True).count() == 20


def test_update_with_a_time_stops_older_changes(spark, tmp_dir, changes):
    t = strict(spark, f"{tmp_dir}/at")
    t.update("record_id < 2", {"val": "'by hand'"}, at="2024-01-01 20:00:00")
    late = latest_one(changes([("U", "A", "late", 0, 15, 1), ("U", "A", "newer", 1, 21, 2), ("U", "A", "plain", 2, 15, 3)]), C)
    got = dict(rows_of(merge(t.read(), late, C).current(), "record_id", "val")[:3])
    assert got == {0: "by hand", 1: "newer", 2: "plain"}
    with pytest.raises(ValueError):
        t.update("true", {"ts": "ts"}, at="2024-01-01 20:00:00")


# ------------------------------------------------------- the end of tombstones
def test_nothing_dropped_comes_back(spark, tmp_dir, changes):
    t = strict(spark, f"{tmp_dir}/low", n=4)
    q = f"{tmp_dir}/lowq"
    s = upsert_batch_fn(t, C, quarantine_path=q, stream_id="s", late_by=dt.timedelta(hours=2))
    s(changes([("D", "A", "d", 1, 11, 1), ("U", "A", "u", 2, 14, 2)]), 0)
    assert t.low_water() == "2024-01-01 12:00:00" and t.read().where("is_deleted").count() == 1
    t.compact()
    assert t.read().where("is_deleted").count() == 0  # 11:00 is below the mark
    s(changes([("U", "A", "late", 1, 10, 3), ("I", "A", "late", 7, 11, 4), ("U", "A", "fine", 3, 13, 5)]), 1)
    got = dict(rows_of(t.read(visible=True), "record_id", "val"))
    assert got == {0: "t0", 2: "u", 3: "fine"}
    bad = spark.read.parquet(q).where("array_contains(reasons, 'below_low_water')")
    assert bad.count() == 2
    # a delete above the mark keeps its tombstone
    s(changes([("D", "A", "d", 3, 14, 6)]), 2)
    t.compact()
    assert rows_of(t.read().where("is_deleted"), "record_id") == [(3,)]
    t.set_low_water("2024-01-01 05:00:00")  # a mark never falls
    assert t.low_water() == "2024-01-01 12:00:00"
    # a second stream holds the mark back
    other = upsert_batch_fn(t, C, quarantine_path=q, stream_id="o", late_by=dt.timedelta(0))
    other(changes([("U", "A", "o", 0, 13, 1)]), 0)
    assert t.low_water() == "2024-01-01 13:00:00"


def test_marks_of_instants(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/inst", key_cols=("k",), ts_col="ts")
    t.write(spark.sql("SELECT id AS k, timestamp_micros(1000000 * id) AS ts, id < 5 AS is_deleted FROM range(10)"))
    t.set_low_water(str(3_000_000))
    t.compact()
    assert sorted(r["k"] for r in t.read().collect()) == [3, 4, 5, 6, 7, 8, 9]
    rows, late = t.split_late(t.read().withColumn("ts", F.expr("timestamp_micros(1000000 * (k - 4))")), "ts")
    assert rows.count() == 3 and late.count() == 4
    empty = VersionedTable(spark, f"{tmp_dir}/noapplied")
    empty.write(spark.range(3))
    with pytest.raises(ValueError):
        empty.set_low_water(lateness=dt.timedelta(1))


# ----------------------------------------------------------- one pass, its log
@pytest.mark.parametrize("kw", [{}, {"strategy": "shuffle"}])
@pytest.mark.parametrize("layout", [{}, {"partition_cols": ("state",)}, {"cluster_keys": ("record_id",), "cluster_buckets": 4}])
def test_apply_equals_merge(spark, tmp_dir, changes, kw, layout):
    t = strict(spark, f"{tmp_dir}/apply", **layout)
    t.delete("record_id in (4, 5)", at="2024-01-01 12:00:00")
    rows = [("U", "B", "u1", 1, 11, 1), ("U", "A", "old", 2, 1, 2), ("D", "A", "d", 3, 11, 3), ("I", "A", "back", 4, 13, 4),
            ("U", "A", "late", 5, 11, 5), ("D", "A", "none", 50, 11, 6), ("U", "C", "new", 51, 11, 7), ("I", "A", "dup", 6, 11, 8)]
    batch = latest_one(changes(rows), C)
    want = merge(t.read(), batch, C)
    want_rows, want_log = rows_of(want.table.select(sorted(want.table.columns))), rows_of(want.conflicts)
    want_counts = {r["action"]: r["n"] for r in want.action_counts().collect()}
    seen = []
    got = applying.apply_changes(t, batch, C, 1, on_conflicts=lambda d: seen.extend(rows_of(d)), **kw)
    assert rows_of(t.read().select(sorted(t.read().columns))) == want_rows and got.version == 2
    assert seen == want_log == rows_of(applying.conflicts_of(t.change_log(), C))
    assert {k: v for k, v in got.counts.items() if v} == want_counts
    assert got.strategy == ("shuffle" if kw else "broadcast")
    assert not set(t.read().columns) & {"_change_op", "_change_action"}
    t.compact()
    with pytest.raises(ValueError):
        t.change_log()  # not a merge's version


def test_a_failed_apply_leaves_nothing(spark, tmp_dir, changes):
    t = strict(spark, f"{tmp_dir}/failed")

    def fail(_):
        raise RuntimeError("no space")

    with pytest.raises(RuntimeError):
        applying.apply_changes(t, latest_one(changes([("U", "A", "u", 1, 11, 1)]), C), C, 0, on_conflicts=fail)
    assert t.versions() == [0] and not t._fs.glob(f"{t.path}/v=1-*")


READS = """
import json, sys
sys.path[:0] = ["{repo}", "{repo}/tests"]
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "{log}").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.checkpoint.dir", "{work}").getOrCreate())
from test_upkeep import strict
from conftest import C
from tidemark.operators.apply import apply_changes, conflicts_of
t = strict(spark, "{work}/t", n=10000)
batch = spark.sql("SELECT 'U' AS op, 'B' AS state, 'n' AS val, id * 500 AS record_id, TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts, id AS seq FROM range(40)")
apply_changes(t, batch, C, 0, on_conflicts=lambda d: d.write.parquet("{work}/conflicts"), strategy="{strategy}")
spark.stop()
"""


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_the_target_is_read_once(strategy):
    """The scans of the target's files by all that an apply runs, its
    conflicts and counts included."""
    work = Path(tempfile.mkdtemp(prefix="tidemark-reads-"))
    (work / "log").mkdir()
    code = READS.format(repo=Path(__file__).resolve().parents[1], log=f"file://{work}/log", work=work, strategy=strategy)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    events = [json.loads(line) for path in (work / "log").iterdir() for line in path.read_text().splitlines()]
    plans = [e["physicalPlanDescription"] for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart")]
    # one scan node of version 0 with its rows' columns, among all the queries
    scans = [x for p in plans for x in p.split("\n\n\n") if "Scan parquet" in x and "/v=0-" in x]
    assert len(scans) == 1 and "val:string" in scans[0]


# ------------------------------------------------------- files, schema versions
def test_add_columns_writes_no_file(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/wide", partition_cols=("state",))
    t.write(spark.range(100).select((F.col("id") % 3).cast("string").alias("state"), "id"))
    files = t._fs.count_files(f"{tmp_dir}/wide")
    t.add_columns({"n": "int", "note": "string"})
    assert t._fs.count_files(f"{tmp_dir}/wide") == files and t.version_path(1) == t.version_path(0)
    assert t.read().columns == ["id", "n", "note", "state"] and t.read().where("n is null").count() == 100
    assert t.read(0).columns == ["id", "state"]
    t.update("id < 3", {"n": "7"})
    assert t.read().where("n = 7").count() == 3
    t.add_columns({"more": "double"})
    with pytest.raises(ValueError):
        t.add_columns({"ID": "int"})
    # the rows of a version that a kept one names stay
    assert t.vacuum(keep=1) == [0, 1, 2] and t.versions() == [3]
    assert t.read().where("n = 7").count() == 3 and t.read().count() == 100
    t.register("tm_wide.t")
    assert spark.table("tm_wide.t").where("more is null and n = 7").count() == 3


def test_add_columns_of_a_clustered_table(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/wk", cluster_keys=("id",), cluster_buckets=4)
    t.write(spark.range(50))
    t.add_columns({"n": "int"})
    assert t.read().where("n is null").count() == 50 and t.read(0).columns == ["id"]
    again = VersionedTable(spark, f"{tmp_dir}/wk", cluster_keys=("id",), cluster_buckets=4)
    again.update("id = 1", {"n": "5"})
    assert again.read().where("n = 5").count() == 1


def test_a_compaction_that_does_nothing_is_seen(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/files", partition_cols=("state",))
    t.write(spark.range(3000).select((F.col("id") % 3).cast("string").alias("state"), "id").repartition(20), rebalance=False)
    t.publish(1, 0, t._meta(0)["data"], t.read(0).select("id", "state").schema)  # a compaction that did nothing
    same = t.compaction_report(0, 1).collect()
    assert all(r["n_files_after"] == 20 > r["n_files_allowed"] for r in same) and len(same) == 3
    v, before, after = t.compact()
    assert before == 60
    done = t.compaction_report(0, v).collect()
    assert all(r["n_files_after"] <= r["n_files_allowed"] and r["n_rows_before"] == r["n_rows_after"] == 1000 for r in done)


# ------------------------------------------------------- literal rows, times
def test_literal_rows_are_checked(spark, tmp_dir):
    from tidemark.plans.upkeep import SEGMENT_CONTRACT, SEGMENTS
    from tidemark.sources.table import literal_rows

    assert literal_rows(spark, list(SEGMENTS), SEGMENT_CONTRACT).count() == 5
    for bad in (("TOO LONG A NAME", "x", 1, "2024-01-01"), ("A", "x", "one", "2024-01-01"), (None, "x", 1, "2024-01-01"), ("A", "x", 1)):
        with pytest.raises(ValueError):
            literal_rows(spark, [bad], SEGMENT_CONTRACT)


def test_change_times_in_several_forms(spark):
    rows = [("2024-01-02 03:04:05.600000",), ("02/01/2024 03:04:05",), ("1704164645",), ("2024-01-02T03:04:05",), ("never",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(
        to_change_time_any("t", ("yyyy-MM-dd HH:mm:ss.SSSSSS", "dd/MM/yyyy HH:mm:ss"), epoch=True)).collect()]
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == [at.replace(microsecond=600000), at, at, at, None, None, None]


# ------------------------------------------------------ latest of wide rows
@pytest.mark.parametrize("limit", [None, -1])
def test_latest_of_wide_rows(spark, changes, limit):
    rng = random.Random(4)
    rows = [(rng.choice(["I", "U", "D", None, "x"]), rng.choice("AB"), rng.choice(["v", "w", None]), rng.choice([None, 1, 2, 3, 4, 5]),
             rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2])) for _ in range(300)]
    df = changes(rows).repartition(4)
    assert rows_of(latest_one(df, C, wide=True, broadcast_limit_bytes=limit)) == rows_of(latest_one(df, C))
    assert latest_one(df.where("false"), C, wide=True).count() == 0


# ---------------------------------------------------------- row-level catalog
def test_catalog_stream_reaches_the_merge_and_skips_replays(spark, tmp_dir, changes):
    """No table format with row-level operations is installed, so the merge ends
    at Spark's capability check; everything up to it runs."""
    from tidemark import job
    from tidemark.sources.catalog import properties
    from tidemark.streaming.upsert import BATCH_PROPERTY, catalog_batch_fn

    spark.sql("DROP TABLE IF EXISTS tm_rowlevel")
    spark.sql("CREATE TABLE tm_rowlevel (state STRING, val STRING, record_id BIGINT, ts TIMESTAMP_NTZ, is_deleted BOOLEAN, "
              f"change_seq BIGINT, extra STRING) USING parquet LOCATION '{tmp_dir}/rowlevel'")
    fn = catalog_batch_fn(spark, "tm_rowlevel", C, quarantine_path=f"{tmp_dir}/q", stream_id="s")
    batch = changes([("U", "A", "v", 1, 1, 1), (None, "A", "v", 2, 1, 2)]).withColumn("extra", F.lit("kept"))
    with pytest.raises(Exception, match="UNSUPPORTED|TABLE_OPERATION"):
        fn(batch, 0)
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 1  # rejected rows are set aside before the merge
    assert f"{BATCH_PROPERTY}s" not in properties(spark, "tm_rowlevel")  # not done
    fn(batch.where("op is null"), 0)  # nothing to merge: the batch is done
    assert properties(spark, "tm_rowlevel")[f"{BATCH_PROPERTY}s"] == "0"
    fn(batch, 0)  # a replay merges nothing
    with pytest.raises(ValueError):
        catalog_batch_fn(spark, "tm_rowlevel", C)
    # the job reaches it too
    (Path(tmp_dir.replace("file:", "")) / "land").mkdir(parents=True, exist_ok=True)
    from tidemark.contract import TOLL_CONTRACT
    from tidemark.sources.landing import write_landing

    toll = spark.createDataFrame([("U", *["x"] * 14, dt.datetime(2024, 1, 1))], "op string, " + ", ".join(
        f"{x} {'timestamp_ntz' if x == TOLL_CONTRACT.ts_col else 'string'}" for x in TOLL_CONTRACT.columns))
    write_landing(toll, f"{tmp_dir}/land", TOLL_CONTRACT)
    spark.sql("DROP TABLE IF EXISTS tm_rowtoll")
    toll.drop("op").where("false").write.option("path", f"{tmp_dir}/rowtoll").saveAsTable("tm_rowtoll")
    with pytest.raises(Exception, match="UNSUPPORTED|TABLE_OPERATION"):
        job.run(spark, f"{tmp_dir}/land", f"{tmp_dir}/cat", mode="compat", catalog_table="tm_rowtoll")


def test_a_writer_whose_rows_were_vacuumed_runs_again(spark, tmp_dir):
    t = strict(spark, f"{tmp_dir}/vac")
    other = strict(spark, f"{tmp_dir}/vac")
    seen = []

    def change(base):
        seen.append(base)
        if len(seen) == 1:  # meanwhile
            other.update("record_id = 1", {"val": "'x'"})
            other.update("record_id = 2", {"val": "'y'"})
            other.vacuum(keep=1)
        return t._update("record_id = 3", {"val": "'z'"}, None, base)

    assert t.transact(change) == 3 and seen == [0, 2]
    got = dict(rows_of(t.read(visible=True), "record_id", "val")[:4])
    assert got == {0: "t0", 1: "x", 2: "y", 3: "z"}
