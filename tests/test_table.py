"""Versioned table: versions, DML, evolution, compaction, layout, catalog."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources.table import VersionedTable, VersionExistsError


def _table(spark, tmp_dir, **kw):
    t = VersionedTable(spark, f"{tmp_dir}/t", partition_cols=("state",), bucket_col="record_id", **kw)
    df = spark.createDataFrame(
        [("A", 1.0, i, None) for i in range(10)] + [("B", -1.0, i, "x") for i in range(10, 20)],
        "state string, amount double, record_id long, note string")
    t.write(df)
    return t


def test_versions_and_reads(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    assert t.versions() == [0]
    assert t.read().columns == ["amount", "record_id", "note", "state"]
    t.delete("record_id < 5")
    assert t.versions() == [0, 1]
    assert t.read().count() == 15 and t.read(0).count() == 20
    for n in (0, 1):  # a published version is neither rewritten nor hidden
        with pytest.raises(VersionExistsError):
            t.write(t.read(0), version=n)
    assert t.read(1).count() == 15


def test_update_and_delete_null_semantics(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.update("note = 'x'", {"amount": "amount * 10"})
    got = {r["record_id"]: r["amount"] for r in t.read().collect()}
    assert got[15] == -10.0 and got[3] == 1.0  # note null -> condition null -> unchanged
    t.delete(F.col("note") == "x")
    assert t.read().count() == 10  # null condition keeps the row


def test_insert_and_add_columns(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.add_columns({"nation": "int"})
    new = spark.createDataFrame([("C", 2.0, 99, None, 7)],
                                "state string, amount double, record_id long, note string, nation int")
    t.insert(new)
    rows = {r["record_id"]: r["nation"] for r in t.read().collect()}
    assert rows[99] == 7 and rows[0] is None and len(rows) == 21


def test_bucket_layout(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    raw = spark.read.parquet(t.version_path(0))
    check = raw.where(F.col("record_id_bucket") != F.pmod(F.hash("record_id"), F.lit(16)))
    assert check.count() == 0
    assert raw.where("state = 'A'").select("record_id_bucket").distinct().count() > 1


def test_compact_reduces_files_rows_unchanged(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/c", partition_cols=("state",))
    df = spark.range(2000).select((F.col("id") % 3).cast("string").alias("state"), "id")
    t.write(df.repartition(40), rebalance=False)
    v, before, after = t.compact()
    assert v == 1 and after < before
    assert sorted(r.id for r in t.read().collect()) == list(range(2000))


def test_empty_version_reads_with_schema(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/e", partition_cols=("state",))
    t.write(spark.createDataFrame([], "state string, id long"))
    assert t.read().count() == 0 and t.read().columns == ["id", "state"]


def test_view_and_catalog_table(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.view("cur_state")
    assert spark.sql("SELECT count(*) AS n FROM cur_state WHERE state = 'B'").first()["n"] == 10
    t.register("tm_db.current_rows")
    t.delete("state = 'B'")
    t.register("tm_db.current_rows")
    assert spark.table("tm_db.current_rows").count() == 10


def test_vacuum_keeps_newest_versions(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    for i in range(3):
        t.delete(f"record_id = {i}")
    assert t.versions() == [0, 1, 2, 3]
    assert t.vacuum(keep=2) == [0, 1]
    assert t.versions() == [2, 3] and t.read().count() == 17


def _plan(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_clustered_merge_shuffles_only_the_batch(spark, tmp_dir):
    from conftest import C, rows_of

    from tidemark.operators.merge import merge

    t = VersionedTable(spark, f"{tmp_dir}/k", cluster_keys=("record_id",), cluster_buckets=8)
    base = spark.range(200).select(F.lit("A").alias("state"), F.col("id").cast("string").alias("val"),
                                   F.col("id").alias("record_id"),
                                   F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("ts"))
    t.write(base)
    assert t.files() == 8  # one file per bucket
    batch = spark.range(150, 260).select(F.lit("U").alias("op"), F.lit("B").alias("state"),
                                         F.lit("new").alias("val"), F.col("id").alias("record_id"),
                                         F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias("ts"))
    res = merge(t.read(), batch, C, mode="strict", strategy="shuffle")
    plan = _plan(res.table)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    t.write(res.table, clustered_input=True)
    assert t.files() == 8  # merged rows went back bucket by bucket
    got = rows_of(t.read(visible=True), "record_id", "val")
    assert len(got) == 260 and got[150] == (150, "new") and got[0] == (0, "0")
    # a new session's catalog: the version's table is re-registered from its schema
    spark.sql(f"DROP TABLE {t.catalog_name(1)}")
    again = VersionedTable(spark, f"{tmp_dir}/k", cluster_keys=("record_id",), cluster_buckets=8)
    assert again.read(visible=True).count() == 260
    plan = _plan(merge(again.read(), batch, C, mode="strict", strategy="shuffle").table)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1


def test_unpublished_clustered_version_is_replaced(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/r", cluster_keys=("record_id",), cluster_buckets=4)
    t.write(spark.range(100).select(F.col("id").alias("record_id"), F.lit("a").alias("v")), version=0)
    t._fs.delete(f"{t.version_path(0)}/_version.json")  # as if the writer had died before publishing
    t.write(spark.range(50).select(F.col("id").alias("record_id"), F.lit("b").alias("v")), version=0)
    assert t.versions() == [0] and t.files(0) == 4
    assert rows_of_v(t.read(0)) == [(i, "b") for i in range(50)]


def rows_of_v(df):
    return sorted((r["record_id"], r["v"]) for r in df.collect())


def test_unpublished_version_is_not_seen(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.delete("record_id < 5")
    t._fs.delete(f"{t.version_path(1)}/_version.json")  # crash between the data and the publication
    assert t.versions() == [0] and t.read().count() == 20
    assert t.delete("state = 'A'") == 1  # the next write takes its place, nothing of it stays
    assert t.read().count() == 10


def _strict(spark, tmp_dir, **kw):
    t = VersionedTable(spark, f"{tmp_dir}/s", key_cols=("record_id",), ts_col="ts", **kw)
    t.write(spark.sql("""
        SELECT 'A' AS state, concat('t', id) AS val, id AS record_id,
               TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts, id = 3 AS is_deleted, id AS change_seq
        FROM range(1, 5)"""))
    return t


def test_strict_insert_is_visible_and_replaces_a_tombstone(spark, tmp_dir):
    t = _strict(spark, tmp_dir)
    t.insert(spark.sql("""
        SELECT 'B' AS state, 'new' AS val, id AS record_id, TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts
        FROM range(3, 6) WHERE id <> 4"""))
    got = sorted((r["record_id"], r["val"]) for r in t.read(visible=True).collect())
    assert got == [(1, "t1"), (2, "t2"), (3, "new"), (4, "t4"), (5, "new")]
    assert t.read().count() == 5  # one row a key


def test_strict_update_leaves_tombstones(spark, tmp_dir):
    t = _strict(spark, tmp_dir)
    t.update("record_id >= 2", {"val": "'x'"})
    got = {r["record_id"]: (r["val"], r["is_deleted"]) for r in t.read().collect()}
    assert got == {1: ("t1", False), 2: ("x", False), 3: ("t3", True), 4: ("x", False)}
    with pytest.raises(ValueError):
        t.update("true", {"no_such_column": "1"})


def test_strict_delete_leaves_a_tombstone_that_stops_late_changes(spark, tmp_dir, changes):
    from conftest import C, rows_of

    from tidemark.operators.latest import latest_one
    from tidemark.operators.merge import merge

    t = _strict(spark, tmp_dir)
    t.delete("record_id <= 2", at="2024-01-01 20:00:00")
    assert rows_of(t.read(visible=True), "record_id") == [(4,)]
    late = [("U", "A", "stale", 1, 15, 99), ("U", "A", "new", 2, 21, 1)]
    res = merge(t.read(), latest_one(changes(late), C), C)
    assert rows_of(res.current(), "record_id", "val") == [(2, "new"), (4, "t4")]
    t.delete("record_id = 4")  # now
    assert t.read(visible=True).count() == 0
    bare = VersionedTable(spark, f"{tmp_dir}/s")
    with pytest.raises(ValueError):
        bare.delete("true")
    with pytest.raises(ValueError):
        bare.insert(t.read(visible=True))


def test_clustered_insert_keeps_the_number_of_files_bounded(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/kc", cluster_keys=("record_id",), cluster_buckets=8)
    t.write(spark.range(200).select(F.col("id").alias("record_id"), F.lit("a").alias("v")))
    t.insert(spark.range(200, 400).select(F.col("id").alias("record_id"), F.lit("b").alias("v")).repartition(50))
    assert t.files() <= 16 and t.read().count() == 400  # not 50 tasks x 8 buckets
    t.update("true", {"record_id": "record_id + 1"})
    assert t.files() == 8 and t.read().count() == 400
