"""Snapshot diff (J1) and reconciliation."""

from conftest import rows_of

from tidemark.contract import ChangeContract
from tidemark.operators.diff import reconcile, reconcile_summary, snapshot_diff
from tidemark.operators.merge import merge

C = ChangeContract(columns=("k", "a", "b", "ts"), key_cols=("k",), ts_col="ts")
S = "k long, a string, b double, ts long"


def test_diff_classes_and_null_changes(spark):
    before = spark.createDataFrame(
        [(1, "x", 1.0, 1), (2, None, 2.0, 1), (3, "z", None, 1), (4, "same", 4.0, 1)], S)
    after = spark.createDataFrame(
        [(2, "now", 2.0, 2), (3, "z", 3.0, 2), (4, "same", 4.0, 1), (5, "new", 5.0, 2)], S)
    d = snapshot_diff(before, after, C)
    assert rows_of(d, "op", "k", "a") == [("D", 1, "x"), ("I", 5, "new"), ("U", 2, "now"), ("U", 3, "z")]


def test_diff_then_merge_turns_a_into_b(spark):
    before = spark.createDataFrame([(i, f"v{i}", float(i), 1) for i in range(50)], S)
    after = spark.createDataFrame(
        [(i, f"v{i}" if i % 7 else "changed", float(i), 2 if i % 7 == 0 else 1) for i in range(10, 60)], S)
    changes = snapshot_diff(before, after, C)
    res = merge(before, changes, C, mode="strict", keep_tombstones=False)
    assert rows_of(res.current()) == rows_of(after)


def test_reconcile(spark):
    src = spark.createDataFrame([(1, "x", 1.0, 1), (2, "y", None, 1), (3, "z", 3.0, 1)], S)
    tgt = spark.createDataFrame([(2, "y", 2.0, 1), (3, "z", 3.0, 1), (4, "w", 4.0, 1)], S)
    rep = reconcile(src, tgt, C)
    assert rows_of(rep, "k", "status", "diff_cols") == [
        (1, "missing", None), (2, "differ", "b"), (4, "extra", None)]
    summary = dict(rows_of(reconcile_summary(reconcile(src, tgt, C, only_mismatches=False)), "status", "n"))
    assert summary == {"missing": 1, "differ": 1, "extra": 1, "match": 1}


def test_diff_of_clustered_snapshots_needs_no_shuffle(spark, tmp_dir):
    import contextlib
    import io

    from pyspark.sql import functions as F

    from tidemark.sources.table import VersionedTable

    def snap(name, shift):
        t = VersionedTable(spark, f"{tmp_dir}/{name}", cluster_keys=("k",), cluster_buckets=8)
        t.write(spark.range(shift, shift + 100).select(
            F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("a"),
            (F.col("id") * 1.5).alias("b"), F.lit(1).cast("long").alias("ts")))
        return t.read()

    d = snapshot_diff(snap("a", 0), snap("b", 50), C)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        d.explain()
    assert "Exchange" not in buf.getvalue() and buf.getvalue().count("Bucketed: true") == 2
    assert rows_of(d.groupBy("op").count(), "op", "count") == [("D", 50), ("I", 50)]


def test_duplicate_keys_are_refused(spark):
    import pytest

    from tidemark.operators.diff import DuplicateKeyError

    ok = spark.createDataFrame([(1, "x", 1.0, 1)], S)
    dup = spark.createDataFrame([(1, "x", 1.0, 1), (1, "y", 2.0, 1)], S)
    with pytest.raises(DuplicateKeyError):
        snapshot_diff(ok, dup, C)
    with pytest.raises(DuplicateKeyError):
        reconcile(dup, ok, C)


def test_null_keys_are_refused(spark):
    import pytest

    from tidemark.operators.diff import NullKeyError

    ok = spark.createDataFrame([(1, "x", 1.0, 1)], S)
    null = spark.createDataFrame([(1, "x", 1.0, 1), (None, "y", 2.0, 1)], S)
    for a, b in ((ok, null), (null, ok), (null, null)):
        with pytest.raises(NullKeyError):
            snapshot_diff(a, b, C)
        with pytest.raises(NullKeyError):
            reconcile(a, b, C)
