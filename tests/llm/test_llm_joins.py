"""Operators that join rows with each other: neighbours, lines, documents, and
the pipeline they stand in."""

import importlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op2_ann as ann
from tidemark.llm import op5_packing as packing
from tidemark.llm import op7_line_dedup as lines
from tidemark.llm import op10_ngram_join as ngram
from tidemark.llm.common import WORD_RE
from tidemark.llm.components import components
from tidemark.llm.encode import Encoder, public_tokenizer

A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def none(df):
    return df.where("false")


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(8, 60)] + [(3, 7), (7, 3), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in [3, 7, *range(8, 60)]} == {3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- nearest neighbours ------------------------------------------------------

def test_ann_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]  # one vector very often
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, [1.0] * 3), (None, rows[0][1])]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, score string")
    p = ann.Ann(sample_rows=1000, leaf_rows=32, block_rows=64)
    got = {}
    for r in ann.search(d, d.where("vec_id % 20 = 0"), p).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = x.astype(float)
    hit = 0
    assert set(got) == set(range(0, 3000, 20))
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(f[2] == s[f[1]] for f in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hit += len({f[1] for f in found} & set(want.tolist()))
    assert hit / (20 * len(got)) >= 0.9


def test_ann_groups_are_bounded_on_both_sides(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8))
    x[:600] = x[0]  # one hot leaf, which many queries visit
    d = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, v array<double>, leaf long")
    p = ann.Ann(leaf_rows=32, block_rows=64, part_rows=32)
    tree = ann.grow(x, p)
    leaf = tree.leaf_of(x)
    index = spark.createDataFrame([(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(x, leaf))], d.schema)
    asked = d.where("vec_id % 2 = 0").select("vec_id", "v")
    rows, asks = (s.select("vec_id", "leaf", "block", "part").toPandas() for s in ann.dealt(index, asked, tree, 3, p, "test"))
    for side, most in ((rows, p.block_rows), (asks, p.part_rows)):
        assert side.groupby(["leaf", "block", "part"]).size().max() <= 2 * most
    # every query meets every row of its leaves once
    met = rows.merge(asks, on=["leaf", "block", "part"])
    assert not met.duplicated(["vec_id_x", "vec_id_y"]).any()
    assert len(met) == sum((leaf == n).sum() for i in range(0, 1500, 2) for n in tree.walk(x[i], 3))
    # the same neighbours whatever the parts
    near = [{tuple(r) for r in ann.search(d, d.where("vec_id % 2 = 0"), ann.Ann(leaf_rows=32, block_rows=64, part_rows=n), vec_col="v").collect()}
            for n in (32, 4096)]
    assert near[0] == near[1] and len(near[0]) == 750 * 20


def test_ann_few_rows(spark):
    d = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (40, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = ann.search(d, d.where("vec_id % 20 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(20, 1, 1), (20, 2, 40), (40, 1, 1), (40, 2, 20)]
    assert ann.search(none(d), none(d)).count() == 0


# -- lines -------------------------------------------------------------------

def brute_removed(docs, percent=90, min_words=5):
    """{doc_id: removed places}, by comparing every pair of lines."""
    rows = sorted({(i is None, i or 0, n, line) for i, t in docs if t is not None for n, line in enumerate(t.split("\n"))},
                  key=lambda r: r[:3])
    out, seen = {}, []
    for last, i, n, line in rows:
        s = frozenset(WORD_RE.findall(line))
        if len(s) < min_words:
            continue
        if any(100 * len(s & o) >= percent * len(s | o) for o in seen):
            out.setdefault(None if last else i, set()).add(n)
        seen.append(s)
    return out


def line_docs(rng, n=150):
    vocabulary = [f"w{i}" for i in range(60)]
    base = [list(rng.choice(vocabulary, rng.integers(3, 40))) for _ in range(25)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(rng.integers(1, 6)):
            line = list(base[rng.integers(len(base))])
            for _ in range(rng.integers(0, 4)):
                line[rng.integers(len(line))] = vocabulary[rng.integers(60)]
            text.append(" ".join(line))
        docs.append((i, "\n".join(text)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_brute_force(spark, seed):
    docs = line_docs(np.random.default_rng(seed))
    docs += [(1000, None), (1001, ""), (1002, "\n \n"), (1003, docs[0][1] + "\n\n" + A), (1004, A), (1004, A), (1005, "a b\na b"),
             (None, A), (1006, " ".join(f"z{i}" for i in range(20_000)))]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, at string")
    want = brute_removed(docs)
    got = {}
    for r in lines.removed_lines(lines.keyed(d)).collect():
        got.setdefault(r["doc"], set()).add(r["at"])
    assert got == want
    for r in lines.deduplicated(d).collect():
        text = next(t for i, t in docs if i == r["doc_id"])
        gone = want.get(r["doc_id"], set())
        assert r["text"] == (text if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone))


def test_copies_of_short_lines(spark):
    many = " ".join(["to be or not"] * 15)  # 60 words, 4 distinct ones
    docs = [(1, f"Read more\n{many}\n\n{A}"), (2, f"Read more\nRead less\n{many}\n\n"), (3, f"more Read\nRead more about\n{A}\n{many}"), (4, "Read")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for p, want in ((lines.Lines(), brute_removed(docs)), (lines.Lines(short_copies=True), brute_removed(docs, min_words=1)),
                    (lines.Lines(percent=50, short_copies=True), {2: {0, 2}, 3: {0, 2, 3}})):
        got = {}
        for r in lines.removed_lines(lines.keyed(d), p).collect():
            got.setdefault(r["doc"], set()).add(r["at"])
        assert got == want
    assert brute_removed(docs, min_words=1) == {2: {0, 2}, 3: {0, 2, 3}}


def test_lines_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert lines.deduplicated(d).count() == 0


def test_lists_of_lines_are_shuffled_once(spark, monkeypatch):
    """Lines that are not settled are joined with the lists they stand in: both
    sides are the same rows, settled or not."""
    plans, plain = [], lines.stored

    def seen(df, name):
        if name.endswith("-pairs"):
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(lines, "stored", seen)
    docs = line_docs(np.random.default_rng(3), 60)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in lines.removed_lines(lines.keyed(d)).collect():
        got.setdefault(r["doc"], set()).add(r["at"])
    assert got == brute_removed(docs)
    assert len(plans) == 1 and "ReusedExchange" in plans[0]


def test_numbers_of_words_are_sorted_as_numbers(spark):
    """Spark sorts arrays that may hold nulls as objects, at twice the cost."""
    d = spark.createDataFrame([(1, A), (2, "c b a b\tc")], "doc_id long, text string")
    levels = lines.rarity(lines.keyed(d), 4, "levels")
    sets = lines.with_levels(d, levels).select(lines.ordered_set(lines.words_of(F.col("text")), 4).alias("s"))
    assert not sets.schema["s"].dataType.containsNull
    for (s,), text in zip(sets.collect(), (A, "c b a b\tc")):
        assert s == sorted(s) and len(set(s)) == len(s) == len(set(text.split())) and min(s) > 0


def test_line_dedup_is_native(spark):
    d = spark.createDataFrame([(1, A), (2, A + " more")], "doc_id long, text string")
    plan = lines.deduplicated(d)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# -- documents ---------------------------------------------------------------

def brute_components(docs, size, percent):
    sets = {}
    for i, t in docs:
        w = WORD_RE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        if i is not None:
            sets.setdefault(i, set()).update([tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else [])
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = sorted((find(a), find(b)))
                root[b_] = a_
    return {i: (len(sets[i]), find(i)) for i in ids}


def shingle_docs(rng, n=120):
    docs, base = [], [[f"v{x}" for x in rng.integers(0, 400, m)] for m in (5, 6, 8, 9, 12, 20, 40, 90, 200, 600)]
    for i in range(n):
        w = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(0, max(2, len(w) // 25))):
            w[rng.integers(len(w))] = f"n{rng.integers(1000)}"
        if rng.random() < 0.3:
            w = w[: max(1, len(w) - rng.integers(0, 3))]
        docs.append((int(rng.permutation(10_000)[0]) * 200 + i, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("join", [ngram.Join(), ngram.STAGE_JOIN])
def test_documents_match_brute_force(spark, seed, join):
    docs = shingle_docs(np.random.default_rng(seed))
    docs += [(-1, None), (-2, ""), (-3, " \n"), (-4, "One"), (-5, "oNE"), (-6, A), (-6, A), (-7, A.upper()), (None, A), (-8, "ÀB c d e"), (-9, "àb c d e")]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, component_id string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram.linked(d, join).collect()}
    assert got == brute_components(docs, join.shingle, join.percent)


def test_probes_and_index_meet_for_every_similar_pair():
    """The partition loses no pair, at sizes of every kind of band."""
    rng = np.random.default_rng(5)
    for percent in (80, 85):
        for n in [*range(4, 40), 77, 150, 444, 1500]:
            for _ in range(6):
                x = rng.integers(0, 2**63, n).astype(np.uint64)
                drop = int(rng.integers(0, n // 5 + 1))
                y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)]))
                x = np.unique(x)
                both = len(np.intersect1d(x, y))
                if not len(y) or len(x) == both == len(y) or 100 * both < percent * (len(x) + len(y) - both):
                    continue
                met = False
                for a, b in ((x, y), (y, x)):
                    own = ngram.band_of(len(b), percent)
                    if ngram.band_of(len(a), percent).number in (own.number, own.number - 1):
                        parts = ngram.segment_keys(ngram.spread(a), own)
                        take, more = ngram.probes(len(a), parts, own, percent)
                        looks = np.concatenate([parts[1][take] ^ ngram.WHOLE, *more])
                        met |= bool(np.isin(looks, ngram.index_keys(ngram.segment_keys(ngram.spread(b), own), own)).any())
                assert met
                flips = sum(int(v).bit_count() for v in (ngram.sketch_of(x) ^ ngram.sketch_of(y)).view(np.uint64))
                assert flips <= len(x) + len(y) - 2 * both


def test_documents_of_nothing(spark):
    assert ngram.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- pipeline ----------------------------------------------------------------

def test_pipeline_against_brute_force(spark):
    """Each stage on its own input, then the packed result on the last."""
    pipeline = importlib.import_module("corpus_pipeline")
    from tidemark.llm import op3_line_rules as rules
    from tidemark.llm.common import stored

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]

    now = pairs(docs)
    want = [(i, j[9]) for i, t in now if (j := rules.judge(t))[6]]
    docs = stored(stages["quality rules"](spark, docs, sf), "t")
    assert sorted(pairs(docs)) == sorted(want)

    gone = brute_removed(want)
    want = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ()))) for i, t in want]
    want = [(i, t) for i, t in want if i not in gone or WORD_RE.search(t)]
    docs = stored(stages["line dedup"](spark, docs, sf), "t")
    assert sorted(pairs(docs)) == sorted(want)

    group = brute_components(want, 5, 80)
    want = [(i, t) for i, t in want if group[i][1] == i]
    docs = stored(stages["n-gram Jaccard join"](spark, docs, sf), "t")
    assert sorted(pairs(docs)) == sorted(want)

    docs = stored(stages["mixing"](spark, docs, sf), "t")
    assert set(pairs(docs)) == set(want) and docs.columns == spark.read.parquet(f"{sf}/documents.parquet").columns

    e = Encoder(public_tokenizer())
    uses = pairs(docs)
    pieces = []
    for i, t in uses:
        ids = np.array([*e.library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        pieces += [(i, a, zlib.crc32(ids[a : a + packing.SEQUENCE].tobytes())) for a in range(0, len(ids), packing.SEQUENCE)]
    out = pipeline.run(spark, sf)
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in out.collect()) == sorted(pieces)


def test_pairs_of_many_shared_keys_come_once(spark):
    # 40 texts of one long passage, each with words of its own at places of its
    # own: similar, but not linked, and of equal subsets in many segments
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for d in range(40):
        words = list(base)
        for at in rng.sample(range(300), 3):
            words[at] = f"own{d}x{at}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    j = ngram.Join()
    live = ngram.shared_keys(ngram.rows_of(docs, j)).where("body is null").withColumn("root", F.col("cls")).cache()
    ids = ngram.rows_of(docs, j).where("body is not null").select((F.col("val") - ngram.MEMBER).alias("cls"), "body") \
        .mapInPandas(ngram.unpacked, ngram._MEMBERS).withColumnRenamed("n_shingles", "n")
    x, y = ngram.shaped(ids, "x"), ngram.shaped(ids, "y")
    every = (live.where("probe").select("key", F.col("cls").alias("x")).join(live.where("found").select("key", F.col("cls").alias("y")), "key")
             .where("x <> y").join(x, "x").join(y, "y").where(ngram.may_link("x", "y", j.percent)).select("x", "y"))
    got = ngram.pairs_apart(live, ids, j, "test").select("x", "y").collect()
    want = every.collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}
    assert len(want) > 3 * len(set(want))
    assert len(got) < 1.5 * len(set(got))
