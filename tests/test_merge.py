"""Merge semantics in both modes and the
properties strict mode promises: fold = one-shot in any order, replay = once."""

import random

import pytest
from conftest import C, rows_of, srt
from pyspark.sql import functions as F

from tidemark.contract import ChangeContract
from tidemark.operators.latest import latest_one, latest_with_ties
from tidemark.operators.merge import MergeCardinalityError, fold, merge, visible

# target rows: (state, val, key, hour)
TARGET = [("A", "t1", 1, 10), ("A", "t2", 2, 10), ("A", "t3", 3, 10)]


def _compat(target, changes, rows, tgt=TARGET, **kw):
    return merge(target(tgt), latest_with_ties(changes(rows), C), C, mode="compat", **kw)


def _strict(target, changes, rows, tgt=TARGET, **kw):
    return merge(target(tgt), latest_one(changes(rows), C), C, mode="strict", **kw)


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_compat_branches(target, changes, strategy):
    rows = [
        ("U", "B", "u1", 1, 11, 1),     # matched update: state stays A (Q6)
        ("D", "A", "d2", 2, 11, 2),     # matched delete
        ("D", "A", "d9", 9, 11, 3),     # delete of absent key: inserted (Q7)
        ("I", "C", "i8", 8, 11, 4),     # insert
        ("U", "A", "old", 3, 1, 5),     # stale: overwrites (Q8)
    ]
    res = _compat(target, changes, rows, strategy=strategy)
    assert res.strategy == ("broadcast" if strategy == "auto" else "shuffle")
    assert rows_of(res.current(), "record_id", "state", "val") == [
        (1, "A", "u1"), (3, "A", "old"), (8, "C", "i8"), (9, "A", "d9")]
    counts = dict(rows_of(res.action_counts(), "action", "n"))
    assert counts == {"update": 2, "delete": 1, "insert": 2}


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_strict_branches(target, changes, strategy):
    rows = [
        ("U", "B", "u1", 1, 11, 1),     # update, state changes (Q6)
        ("D", "A", "d2", 2, 11, 2),     # delete -> tombstone
        ("D", "A", "d9", 9, 11, 3),     # delete of absent key: ignored, tombstone kept (J4)
        ("I", "C", "i8", 8, 11, 4),     # insert
        ("U", "A", "old", 3, 1, 5),     # stale: ignored (Q8)
        ("I", "A", "again", 1, 9, 6),   # older than key 1's update in the same batch
    ]
    res = _strict(target, changes, rows, strategy=strategy)
    assert rows_of(res.current(), "record_id", "state", "val") == [
        (1, "B", "u1"), (3, "A", "t3"), (8, "C", "i8")]
    dead = rows_of(res.table.where("is_deleted"), "record_id")
    assert dead == [(2,), (9,)]
    counts = dict(rows_of(res.action_counts(), "action", "n"))
    assert counts == {"update": 1, "delete": 1, "absent_delete": 1, "insert": 1, "ignore": 1}


def test_insert_on_existing_key_updates(target, changes):
    res = _strict(target, changes, [("I", "A", "x", 1, 12, 1)])
    assert rows_of(res.current().where("record_id = 1"), "val") == [("x",)]
    res = _compat(target, changes, [("I", "A", "x", 1, 12, 1)])
    assert rows_of(res.current().where("record_id = 1"), "val") == [("x",)]


def test_compat_null_key_inserted_every_run(target, changes):
    rows = [("U", "A", "k", None, 1, 1)]
    first = _compat(target, changes, rows).current()
    second = merge(first, latest_with_ties(changes(rows), C), C, mode="compat").current()
    assert second.where("record_id IS NULL").count() == 2


def test_compat_replayed_delete_resurrects(target, changes):
    rows = [("D", "A", "gone", 1, 11, 1)]
    once = _compat(target, changes, rows).current()
    assert once.where("record_id = 1").count() == 0
    twice = merge(once, latest_with_ties(changes(rows), C), C, mode="compat").current()
    assert rows_of(twice.where("record_id = 1"), "val") == [("gone",)]  # Q10


def test_strict_replay_is_idempotent(target, changes):
    rows = [("D", "A", "gone", 1, 11, 1), ("U", "B", "u", 2, 11, 2), ("I", "A", "n", 7, 11, 3)]
    once = _strict(target, changes, rows).table
    twice = merge(once, latest_one(changes(rows), C), C, mode="strict").table
    assert rows_of(once) == rows_of(twice)


def test_strict_tombstone_blocks_older_insert(target, changes):
    deleted = _strict(target, changes, [("D", "A", "x", 1, 20, 1)]).table
    late = merge(deleted, latest_one(changes([("I", "A", "late", 1, 15, 2)]), C), C).current()
    assert late.where("record_id = 1").count() == 0
    newer = merge(deleted, latest_one(changes([("I", "A", "new", 1, 25, 3)]), C), C).current()
    assert rows_of(newer.where("record_id = 1"), "val") == [("new",)]


def test_strict_without_tombstones_drops_deletes(target, changes):
    res = _strict(target, changes, [("D", "A", "x", 1, 20, 1), ("D", "A", "y", 9, 20, 2)],
                  keep_tombstones=False)
    assert rows_of(res.table, "record_id") == [(2,), (3,)]


def test_compat_cardinality_error(target, changes):
    tie = [("U", "A", "a", 1, 11, 1), ("U", "A", "b", 1, 11, 2)]
    with pytest.raises(MergeCardinalityError):
        _compat(target, changes, tie)
    # unmatched tied keys are all inserted, as the format does
    res = _compat(target, changes, [("I", "A", "a", 5, 11, 1), ("I", "A", "b", 5, 11, 2)])
    assert res.current().where("record_id = 5").count() == 2


def test_broadcast_gate_uses_measured_size(target, changes):
    rows = [("U", "A", "u", 1, 11, 1)]
    assert _compat(target, changes, rows).strategy == "broadcast"
    res = _compat(target, changes, rows, broadcast_limit_bytes=8)
    assert res.strategy == "shuffle"
    assert res.batch_size.rows == 1 and res.batch_size.bytes > 8


def _random_feed(rng, n_keys, n_rows):
    # few distinct times: many changes of a key share a time across batches,
    # so the kept sequence must order them the same way in any batch order
    return [(rng.choice("IUD"), rng.choice("AB"), f"v{i}", rng.randrange(n_keys), rng.randrange(30), i)
            for i in range(n_rows)]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_strict_fold_any_order_equals_one_shot(spark, target, changes, seed):
    rng = random.Random(seed)
    rows = _random_feed(rng, 40, 300)
    tgt = [("A", f"t{k}", k, rng.randrange(30)) for k in range(0, 40, 2)]
    one_shot = visible(merge(target(tgt), latest_one(changes(rows), C), C).table)
    cuts = sorted(rng.sample(range(1, len(rows)), 3))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    rng.shuffle(parts)
    folded = visible(fold(target(tgt), [changes(p) for p in parts], C))
    assert rows_of(folded) == rows_of(one_shot)


def test_merge_into_catalog_reaches_table_check(spark):
    """The table-format path builds a valid MERGE; a plain Parquet table has no
    row-level support, so Spark refuses it at the table capability check."""
    from pyspark.sql import functions as F

    from tidemark.operators.merge import merge_into_catalog

    spark.sql("CREATE TABLE IF NOT EXISTS tm_merge_target (state string, val string, record_id long, "
              "ts timestamp_ntz, is_deleted boolean) USING parquet")
    b = spark.createDataFrame([("U", "A", "v", 1)], "op string, state string, val string, record_id long") \
        .withColumn("ts", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    for mode in ("strict", "compat"):
        with pytest.raises(Exception, match="MERGE"):
            merge_into_catalog("tm_merge_target", b, C, mode=mode)


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_merge_carries_evolved_columns(spark, target, changes, strategy):
    from pyspark.sql import functions as F

    tgt = target(TARGET).withColumn("nation", F.col("record_id").cast("int") * 10)
    batch = latest_one(changes([("U", "B", "u1", 1, 11, 1), ("I", "A", "i8", 8, 11, 2)]), C)
    strict = merge(tgt, batch, C, strategy=strategy).current()
    assert strict.columns == ["state", "val", "record_id", "ts", "nation"]
    assert rows_of(strict, "record_id", "nation") == [(1, 10), (2, 20), (3, 30), (8, None)]
    with_col = batch.withColumn("nation", F.lit(7))
    strict = merge(tgt, with_col, C, strategy=strategy).current()
    assert rows_of(strict, "record_id", "nation") == [(1, 7), (2, 20), (3, 30), (8, 7)]
    compat = merge(tgt, with_col, C, mode="compat", strategy=strategy).current()
    # compat: UPDATE SET lists only contract columns; INSERT takes the batch's
    assert rows_of(compat, "record_id", "nation") == [(1, 10), (2, 20), (3, 30), (8, 7)]


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_composite_key(spark, strategy):
    from tidemark.contract import ChangeContract
    from tidemark.operators.diff import snapshot_diff

    c = ChangeContract(columns=("a", "b", "v", "ts"), key_cols=("a", "b"), ts_col="ts", seq_col="seq")
    tgt = spark.createDataFrame([(1, "x", "t1", 1), (1, "y", "t2", 1), (2, "x", "t3", 1)],
                                "a int, b string, v string, ts int")
    ch = spark.createDataFrame(
        [("U", 1, "x", "u", 2, 1), ("D", 1, "y", None, 2, 2), ("I", 2, "y", "n", 2, 3),
         ("U", 1, "x", "older", 0, 4), ("U", None, "x", "nk", 5, 5), ("U", None, "x", "nk2", 5, 6)],
        "op string, a int, b string, v string, ts int, seq int")
    strict = merge(tgt, latest_one(ch, c), c, strategy=strategy).current()
    assert rows_of(strict, "a", "b", "v") == [(1, "x", "u"), (2, "x", "t3"), (2, "y", "n")]
    ties = latest_with_ties(ch, c)
    assert rows_of(ties.where("a IS NULL"), "v") == [("nk",), ("nk2",)]  # null part: one group, tie kept
    compat = merge(tgt, ties, c, mode="compat", strategy=strategy).current()
    assert rows_of(compat, "a", "b", "v") == [(1, "x", "u"), (2, "x", "t3"), (2, "y", "n"),
                                              (None, "x", "nk"), (None, "x", "nk2")]
    after = spark.createDataFrame([(1, "x", "t1", 1), (2, "x", "t3b", 1)], "a int, b string, v string, ts int")
    assert rows_of(snapshot_diff(tgt, after, c), "op", "a", "b") == [("D", 1, "y"), ("U", 2, "x")]


def test_conflict_log(target, changes):
    rows = [
        ("I", "A", "dup", 1, 11, 1),    # insert of a live key
        ("U", "A", "u9", 9, 11, 2),     # update of a missing key
        ("D", "A", "d8", 8, 11, 3),     # delete of a missing key
        ("U", "A", "ok", 2, 11, 4),     # fits
        ("I", "A", "old", 3, 1, 5),     # insert of a live key, stale
    ]
    res = _strict(target, changes, rows)
    assert rows_of(res.conflicts, "record_id", "conflict", "action") == [
        (1, "insert_existing", "update"), (3, "insert_existing", "ignore"),
        (8, "delete_missing", "absent_delete"), (9, "update_missing", "insert")]
    res = _compat(target, changes, rows)
    assert rows_of(res.conflicts, "record_id", "conflict", "action") == [
        (1, "insert_existing", "update"), (3, "insert_existing", "update"),
        (8, "delete_missing", "insert"), (9, "update_missing", "insert")]


def test_source_values_take_target_types(spark):
    from tidemark.contract import ChangeContract

    c = ChangeContract(columns=("k", "n", "ts"), key_cols=("k",), ts_col="ts")
    tgt = spark.createDataFrame([(1, 10, 1)], "k long, n int, ts long")
    b = spark.createDataFrame([("U", 1, "11", 2), ("I", 2, "7", 2)], "op string, k long, n string, ts long")
    for mode in ("strict", "compat"):
        out = merge(tgt, b, c, mode=mode).current()
        assert out.schema["n"].dataType.simpleString() == "int"
        assert rows_of(out, "k", "n") == [(1, 11), (2, 7)]


def test_strict_refuses_two_changes_for_one_key(spark, target, changes):
    rows = [("U", "A", "x", 1, 11, 1), ("U", "A", "y", 1, 12, 2)]
    for strategy in ("auto", "shuffle"):
        with pytest.raises(MergeCardinalityError):
            merge(target([("A", "t1", 1, 10)]), changes(rows), C, strategy=strategy)
    text = changes([("U", "A", "x", 7, 11, 1), ("U", "A", "y", 8, 12, 2)]).withColumn(
        "record_id", F.when(F.col("record_id") == 7, "7").otherwise("07"))
    with pytest.raises(MergeCardinalityError):  # two text keys, one key of the target
        merge(target([]), text, C)


def test_equal_times_do_not_depend_on_input_order(spark, target, changes):
    """Without a sequence the row itself orders changes of one time: in a
    reduction, and in folds in any order."""
    import itertools

    c = ChangeContract(columns=C.columns, key_cols=C.key_cols, ts_col="ts")
    rows = [("U", "A", "y", 1, 11, None), ("U", "A", "x", 1, 11, None), ("I", "B", "x", 1, 11, None),
            ("D", "A", "a", 2, 11, None), ("U", "A", "z", 2, 11, None), ("U", None, None, 3, 11, None),
            ("U", "A", None, 3, 11, None)]
    want = [("B", "x", 1), ("A", None, 3)]
    for order in (rows, rows[::-1]):
        one = latest_one(changes(order).drop("seq").coalesce(1), c)
        assert rows_of(one.where("op <> 'D'"), "state", "val", "record_id") == srt(want)
        assert one.count() == 3
    pairs = [rows[0:2], rows[2:5], rows[5:7]]
    for perm in itertools.permutations(pairs):
        state = fold(target([("A", "t", 1, 10)]), [changes(b).drop("seq") for b in perm], c)
        assert rows_of(visible(state), "state", "val", "record_id") == srt(want)


def test_text_sequence_is_refused_unless_declared(changes):
    from dataclasses import replace

    from pyspark.sql import types as T

    df = changes([("U", "A", "nine", 1, 11, 9), ("U", "A", "ten", 1, 11, 10)])
    text = df.withColumn("seq", F.col("seq").cast("string"))
    assert rows_of(latest_one(df, C), "val") == [("ten",)]
    with pytest.raises(ValueError):
        latest_one(text, C)
    assert rows_of(latest_one(text, replace(C, seq_type=T.StringType())), "val") == [("nine",)]


def test_column_names_match_without_case(target, changes):
    upper = target([("A", "t1", 1, 10), ("A", "t2", 2, 10)]).withColumnsRenamed({"val": "VAL", "record_id": "Record_Id"})
    out = merge(upper, latest_one(changes([("U", "B", "u1", 1, 11, 1)]), C), C).current()
    assert out.columns == list(C.columns)
    assert rows_of(out, "record_id", "val") == [(1, "u1"), (2, "t2")]


@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_null_keys_pass_beside_the_join(target, changes, strategy):
    tgt = [("A", "n1", None, 10), ("A", "n2", None, 11), ("A", "t1", 1, 10)]
    batch = latest_with_ties(changes([("U", "B", "n3", None, 12, 1), ("U", "B", "u1", 1, 12, 2)]), C)
    out = merge(target(tgt), batch, C, mode="compat", strategy=strategy).table
    assert rows_of(out, "val", "record_id") == srt([("n1", None), ("n2", None), ("n3", None), ("u1", 1)])


def test_rows_without_a_delete_flag_are_live(target):
    df = target([("A", "t1", 1, 10)]).withColumn("is_deleted", F.lit(None).cast("boolean"))
    assert visible(df).count() == 1


def test_changes_with_map_columns_are_ordered_too(spark):
    c = ChangeContract(columns=("k", "m", "ts"), key_cols=("k",), ts_col="ts")
    df = spark.sql("SELECT 'U' AS op, 1 AS k, map('a', v) AS m, 5 AS ts FROM VALUES (1), (3), (2) AS t(v)")
    out = merge(spark.sql("SELECT 1 AS k, map('a', 2) AS m, 5 AS ts"), latest_one(df, c), c).current()
    assert [r["m"] for r in out.collect()] == [{"a": 3}]


def test_nested_columns_are_measured_before_a_broadcast(spark):
    from tidemark.plans.sizing import fits_broadcast, measure

    small = spark.range(10).select("id", F.array(F.lit("x")).alias("a"))
    big = spark.range(10).select("id", F.array(F.repeat(F.lit("x"), 100_000)).alias("a"))
    many = spark.range(10).select("id", F.sequence(F.lit(1), F.lit(10_000)).alias("a"))
    nulls = spark.range(10).select("id", F.array_repeat(F.lit(None).cast("int"), 10_000).alias("a"))
    assert measure(small).bytes < 2000
    assert measure(big).bytes > 1_000_000
    assert measure(many).bytes > 10 * 8 * 10_000 and measure(nulls).bytes > 10 * 8 * 10_000
    assert fits_broadcast(small, 100_000)[0] and not fits_broadcast(big, 100_000)[0]
    odd = spark.range(3).select(F.expr("parse_json('1')").alias("v"))
    assert fits_broadcast(odd, 10**9) == (False, fits_broadcast(odd, 0)[1])  # unmeasured: not broadcast
