"""Latest change per key: the compat rules (Q1-Q5) and the strict form."""

from conftest import C, rows_of, srt, t

from tidemark.operators.latest import latest_one, latest_with_ties, split_valid

# (op, state, val, key, hour, seq)
EDGE = [
    ("I", "A", "v1", 1, 1, 1), ("U", "A", "v2", 1, 2, 2),      # newer wins
    (None, "A", "x", 2, 1, 3),                                 # null op latest
    ("I", "A", "a", 6, 1, 4), ("", "A", "b", 6, 2, 5),         # unknown op latest
    ("U", "A", "t1", 4, 1, 6), ("U", "A", "t2", 4, 1, 7),      # tie
    ("I", "A", "n", 5, None, 8),                               # null time
    ("U", "A", "k", None, 1, 9),                               # null key
    ("D", "A", "d", 3, 1, 10),                                 # delete
]


def test_compat_edge_rows(changes):
    out = latest_with_ties(changes(EDGE), C)
    got = rows_of(out, "record_id", "op", "val")
    assert got == srt([
        (1, "U", "v2"),
        (3, "D", "d"),
        (4, "U", "t1"), (4, "U", "t2"),   # Q2: both tied rows kept
        (None, "U", "k"),                 # Q5: null key is one group
    ])
    # Q1: keys 2 and 6 vanish (latest op null / unknown); Q3: key 5 (null time) drops


def test_compat_fillna_has_no_effect(changes):
    df = changes(EDGE)
    # B1: a null op filled with '' is refused by the op filter either way.
    a = latest_with_ties(df, C).collect()
    b = latest_with_ties(df.fillna({"op": ""}), C).collect()
    key = lambda r: (r["seq"],)
    assert sorted(a, key=key) == sorted(b, key=key)


def test_op_match_is_case_sensitive(changes):
    out = latest_with_ties(changes([("i", "A", "x", 1, 1, 1)]), C)
    assert out.count() == 0


def test_strict_edge_rows(changes):
    good, bad = split_valid(changes(EDGE), C)
    out = latest_one(good, C, assume_valid=True)
    got = rows_of(out, "record_id", "op", "val")
    assert got == [(1, "U", "v2"), (3, "D", "d"), (4, "U", "t2"), (6, "I", "a")]
    reasons = {(r["seq"], tuple(r["reasons"])) for r in bad.collect()}
    assert reasons == {(3, ("bad_op",)), (5, ("bad_op",)), (8, ("null_time",)), (9, ("null_key",))}
    assert good.count() + bad.count() == len(EDGE)


def test_strict_orders_by_time_then_seq(changes):
    rows = [("U", "A", "late-seq", 1, 5, 9), ("U", "A", "early-seq", 1, 5, 2), ("U", "A", "old", 1, 4, 99)]
    assert rows_of(latest_one(changes(rows), C), "val") == [("late-seq",)]


def test_hot_key_keeps_all_rows_correct(changes):
    # One key holds a third of the rows; the partial aggregate absorbs it.
    rows = [("U", "A", f"h{i}", 7, i % 50, i) for i in range(3000)]
    rows += [("I", "A", f"k{k}", k, 1, 10000 + k) for k in range(6000)]
    df = changes(rows)
    one = latest_one(df, C)
    assert one.count() == 6000
    hot = one.where("record_id = 7").first()
    # max hour is 49; among those the greatest seq is 2999
    assert (hot["ts"], hot["seq"]) == (t(49), 2999)
    ties = latest_with_ties(df, C).where("record_id = 7")
    assert ties.count() == 60  # every row at hour 49


def test_ties_over_the_bound_use_sort_merge(changes):
    import contextlib
    import io

    df = changes(EDGE)
    big = latest_with_ties(df, C, broadcast_limit_bytes=0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        big.explain()
    assert "SortMergeJoin" in buf.getvalue() and "BroadcastHashJoin" not in buf.getvalue()
    assert rows_of(big) == rows_of(latest_with_ties(df, C))
