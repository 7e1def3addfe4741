"""Operators that read one text or page at a time: rules, counts, quality, main
text, licenses, packing and mixing."""

import textwrap
import warnings
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op1_mixing as mix
from tidemark.llm import op3_line_rules as rules
from tidemark.llm import op4_token_counts as counts
from tidemark.llm import op5_packing as packing
from tidemark.llm import op6_line_crf as crf
from tidemark.llm import op8_html_text as html
from tidemark.llm import op9_licenses as licenses
from tidemark.llm.common import BATCH_BYTES, WORD_RE
from tidemark.llm.encode import Encoder, public_tokenizer

CLEAN = "The quick brown fox jumps over the lazy dog, and nobody minds at all.\nA second line says something else entirely, in plain words."
JUNK = "Buy### now*** cheap$$$ pills%%% here### today*** only$$$ best%%% price### ever***"
#: Null, empty, blank, very long, repeated rows, a null id.
ODD = [(1, CLEAN), (2, None), (3, ""), (4, " \t\n \n"), (5, "word " * 30_000), (6, CLEAN), (6, CLEAN), (None, CLEAN),
       (7, JUNK), (8, "x"), (9, "\n\n" + CLEAN + "\n\n"), (10, "日本 語 a　b c d <|endoftext|> e  f")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, True, "mine") for i, t in ODD],
                                 "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score string")


def none(df):
    return df.where("false")


def brute_repeat(words, size=5):
    at = {}
    for i in range(len(words) - size + 1):
        at.setdefault(tuple(words[i : i + size]), []).append(i)
    return len({i + o for found in at.values() if len(found) > 1 for i in found for o in range(size)})


def test_repeated_windows_match_brute_force():
    rng = np.random.default_rng(1)
    for n, v in ((4, 2), (5, 1), (30, 2), (200, 3), (400, 40), (3000, 2500)):
        words = [str(x) for x in rng.integers(0, v, n)] + ["a", "b", "c", "d", "e"] * 2
        assert rules.repeated_window_words(words) == brute_repeat(words)
    wide = [str(i) for i in range(8000)]  # too many words to pack five in one number
    assert rules.repeated_window_words(wide + wide[100:200]) == 200


def test_rules(odd):
    got = {(r["doc_id"], r["n_words"]): r for r in rules.judged(odd).select("doc_id", "judged.*").collect()}
    assert len(rules.judged(odd).collect()) == len(ODD)
    assert got[1, 24]["kept"] and got[9, 24]["kept"] and got[None, 24]["kept"]
    assert got[2, 0]["base_failed"] and got[3, 0]["base_failed"] and got[4, 0]["base_failed"] and got[8, 1]["base_failed"]
    assert got[5, 30_000]["base_failed"] and got[5, 30_000]["n_repeat_words"] == 30_000
    assert not got[7, 10]["kept"] and not got[7, 10]["base_failed"]
    assert rules.judged(none(odd)).count() == 0


def test_failing_lines_go_and_few_of_them_do_not_reject():
    prose = [" ".join(f"word{k + i}" for i in range(40)) + ", and so on." for k in (0, 100)]
    j = rules.judge(f"{prose[0]}\nhome | news | sport | more\n{prose[1]}")
    assert j[6] and j[7] == 1 and "home |" not in j[9]


def test_stage_keeps_columns(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    out = rules.stage(spark, docs, "")
    assert out.columns == docs.columns and 7 not in [r["doc_id"] for r in out.collect()]


def test_ids_equal_the_library():
    e = Encoder(public_tokenizer())
    texts = [t for _, t in ODD] + [" a", "a ", "it's 's a", "a\n\nb", "a\n b", "é è\tü", "w" * 500 + " x " + "w" * 500]
    want = [e.library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.ids(texts)] == want


def test_token_counts_and_cache(spark, odd, tmp_dir):
    e = Encoder(public_tokenizer())
    want = sorted((str(i), len((t or "").encode()), len(e.library.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD)
    for _ in range(2):  # the second time from the cache
        got = counts.token_counts(odd, tmp_dir).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    stored = spark.read.parquet(tmp_dir)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in ODD})
    assert counts.token_counts(none(odd), tmp_dir).count() == 0


def brute_first_fit(lengths, capacity):
    free, out = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if b == len(free):
            free.append(capacity)
        free[b] -= lengths[i]
        out[i] = b
    return out


def test_tournament_tree_is_first_fit():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 64, 300):
        lengths = rng.integers(1, 101, n)
        assert packing.first_fit_decreasing(lengths, 100)[0].tolist() == brute_first_fit(lengths.tolist(), 100)


def test_packing_round_trip(odd):
    e = Encoder(public_tokenizer())
    got = packing.packed(odd, sequence=64, group_pieces=50).collect()
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    pieces = sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    want = []
    for i, t in ODD:
        ids = np.array([*e.library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(i), a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes()), len(ids)) for a in range(0, len(ids), 64)]
    assert pieces == sorted(want)
    assert packing.packed(none(odd)).count() == 0


def brute_marginals(z, step):
    """All labellings of one chain."""
    n, total, good = len(z), 0.0, np.zeros(len(z))
    for labels in np.ndindex(*(2,) * n):
        w = np.exp(sum(z[i] for i in range(n) if labels[i]) + sum(step[labels[i], labels[i + 1]] for i in range(n - 1)))
        total += w
        good += w * np.array(labels)
    return good / total


def test_forward_backward_matches_all_labellings():
    rng = np.random.default_rng(3)
    step = rng.normal(size=(2, 2))
    scores = [rng.normal(size=n) for n in (1, 2, 5, 3, 8, 1)]
    for got, z in zip(crf.marginals(scores, step, cells=6), scores):
        assert np.allclose(got, brute_marginals(z, step))


def test_crf_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    r = crf.op6_line_crf(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    # 94 rows here, of which 91 are right; 0.998 of 5,099 on the larger check table
    assert len(r) > 50 and (r["predicted"] == r["quality"]).mean() > 0.95


def test_crf_odd_rows_and_missing_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 0), (7, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, none(labels)):
        r = crf.scored(odd, crf.train(odd, known), out="s").collect()
        assert len(r) == len(ODD) and all(0 <= x["s"] <= 1 for x in r)
    assert crf.scored(none(odd), crf.train(odd, labels)).count() == 0


def test_main_text():
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav>"
            "<div class='cookie-notice'>We use cookies and say so in a long sentence, which is no part of the article.</div>"
            "<article><h1>Head &amp;\n line</h1><p>One <b>two</b><br>three.<p>Short.</p><aside>By the way.</aside>"
            "<div class='ad'>Buy this now.</div><section class='comments'><p>First! I like it very much indeed.</p></section>"
            "<p>Last &lt;one&gt;&nbsp;here.</p></article><form>Name <input></form><footer>&copy; us</footer></body></html>")
    assert html.main_text(page) == "Head & line\n\nOne two three.\n\nShort.\n\nLast <one> here."
    assert html.main_text(None) == html.main_text("") == html.main_text("<p>") == ""
    plain = "<body><div><a href=1>Menu</a></div><p>" + "many words " * 20 + "</p><div>" + "<a href=x>link link</a> " * 9 + "</div>"
    assert html.main_text(plain) == ("many words " * 20).strip()


def test_labelled_blocks_are_told_apart():
    x, y = html.labelled_table()
    assert (html.classify(html.trained(), x) == y).mean() > 0.97


def test_pages(spark):
    rows = [(1, "u", "<article><p>Text of it.</p></article>"), (2, None, None), (2, None, None), (None, "v", "")]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    assert [r["text"] for r in html.extracted(d).collect()] == ["Text of it.", "", "", ""]
    assert html.extracted(none(d)).count() == 0


def test_licenses(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, f"Some text.\n{notice}\nMore."), (2, "Licensed under CC BY-NC 4.0."), (3, "Licensed under CC BY 4.0."),
            (4, f"Words before it. {notice} Words after it."), (5, None), (6, ""), (7, "My driving licence was renewed."),
            (8, "This work is licensed under the GNU General Public License, version 2."), (None, notice), (1, f"Some text.\n{notice}\nMore."),
            (9, "Licensed under the Apache License, Version 1.1.")]
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    got = licenses.licenses(d).collect()
    assert sorted((str(r["doc_id"]), r["license"]) for r in got) == sorted([
        ("1", "Apache-2.0"), ("1", "Apache-2.0"), ("2", "CC-BY-NC-4.0"), ("3", "CC-BY-4.0"), ("4", "Apache-2.0"),
        ("8", "GPL-2.0"), ("None", "Apache-2.0")])
    at = next(r for r in got if r["doc_id"] == 4)
    assert rows[3][1][at["block_start"] : at["block_start"] + at["block_chars"]].startswith("Licensed under the Apache")
    assert licenses.licenses(none(d)).count() == 0


def wrapped(text, mark="", width=60):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# ", "REM "])
def test_wrapped_licenses(spark, mark):
    long = [(n, t) for n, _, t in licenses.TEMPLATES if len(t) > 120]
    assert {"MIT", "BSD", "GPL-3.0", "Apache-2.0"} <= {n for n, _ in long}
    rows = [(i, f"int a;\n\n{wrapped(t, mark)}\n\nint b;") for i, (_, t) in enumerate(long)]
    got = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license"], r["exact"]) for r in got) == [(i, n, True) for i, (n, _) in enumerate(long)]


def found(spark, *texts):
    rows = licenses.licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [sorted((r["license"], texts[i][r["block_start"] : r["block_start"] + r["block_chars"]]) for r in rows if r["doc_id"] == i)
            for i in range(len(texts))]


def test_license_in_a_long_sentence(spark):
    by_length = [f"{head} are released under the MIT License." for head in (
        "All of the tools", "The scanner, the packer and every helper that the nightly build collects from the other folders of the project",
        "The scanner, the packer, each helper that the nightly build collects from other folders of this project, its manual pages, the "
        "examples that visitors asked for, several drawings of the harbour and whatever the volunteers sent us last winter")]
    assert found(spark, *by_length) == [[("MIT", "released under the MIT License")]] * 3


def test_several_licenses_in_a_line(spark):
    a, m, g = "Licensed under the Apache License, Version 2.0", "Released under the MIT License", "This work is licensed under the GNU General Public License, version 3"
    both = [("Apache-2.0", a), ("MIT", m)]
    assert found(spark, f"{a}. {m}.", f"{m} / {a}.", f"{a}. Some words between them. {m}. {a}. {g}.", f"{m}. {m}") == [
        both, both, sorted([*both, both[0], ("GPL-3.0", g)]), [both[1]] * 2]


def test_mixing_meets_targets(spark):
    sf = "/root/testdata/sf0.01"
    m = mix.Mix()
    r = mix.op1_mixing(spark, sf).toPandas()
    p, t = np.vstack(r["posterior"]), r["n_tokens"].to_numpy()
    got = (t * r["rate"].to_numpy()) @ p
    assert np.abs(got / got.sum() - np.array(list(m.targets.values()))).max() < 1e-3
    # the same steps on one machine
    have, rate = t @ p, np.ones(len(t))
    want = np.array(list(m.targets.values())) * have.sum()
    for _ in range(m.steps):
        s = (t * rate) @ p
        if np.abs(s - want).max() <= m.tolerance * want.sum():
            break
        rate = np.clip(rate - p @ ((s - want) / have), m.min_rate, m.max_rate)
    assert np.abs(rate - r["rate"]).max() < 1e-4
    texts = {d["doc_id"]: d["text"] for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(n == len(WORD_RE.findall(texts[i] or "")) for i, n in zip(r["doc_id"], t))


def test_mixing_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, none(labels)):
        r = mix.mixed(odd, known).collect()
        assert len(r) == len(ODD) and all(x["rate"] >= 0 and x["copies"] >= 0 for x in r)
    assert mix.mixed(none(odd), labels).count() == 0


def members_of(spark, p, tokens):
    return spark.createDataFrame([(t, v.tolist()) for t, v in zip(tokens.tolist(), p)], "n_tokens long, posterior array<double>").repartition(2)


@pytest.mark.parametrize("blur, bounded", [(0.0, True), (0.05, True), (0.3, False)])
def test_mixing_of_a_corpus_of_one_domain(spark, blur, bounded):
    share = {"en": 0.95, "de": 0.02, "fr": 0.02, "es": 0.01}
    p = np.vstack([np.tile(np.eye(4)[i] * (1 - blur) + blur / 4, (int(s * 2000), 1)) for i, s in enumerate(share.values())])
    tokens = np.full(len(p), 50)
    free = mix.Mix(targets=mix.STAGE_MIX.targets)
    for m in (free, mix.STAGE_MIX)[: 1 + bounded]:
        history, reached, wanted = mix.solve(members_of(spark, p, tokens), m)
        rate = mix.replayed(p, history, m.min_rate, m.max_rate)
        assert np.allclose((tokens * rate) @ p, reached) and (rate >= m.min_rate).all()
        with warnings.catch_warnings(record=True) as told:
            warnings.simplefilter("always")
            missed = mix.residuals(reached, wanted, m)
        if m is free or not blur:  # nothing is in the way
            assert max(map(abs, missed.values())) <= m.tolerance and not told
            assert np.allclose(reached / reached.sum(), list(m.targets.values()), atol=1e-3)
            assert rate[-1] > 8 or len(history) > 60
        else:  # documents of the others add to en, which must not lose any
            assert missed["en"] > m.tolerance and len(told) == 1 and "en" in str(told[0].message)


def test_mixing_says_what_it_misses(spark, odd):
    with pytest.warns(UserWarning, match="misses its targets"):
        out = mix.mixed(odd, none(spark.createDataFrame([(1, 1)], "doc_id long, quality int")))
    assert out.schema["rate"].metadata["residuals"].keys() == mix.Mix().targets.keys()


def test_mixing_stage_keeps_every_document(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mix.stage(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_mixing_stage_holds_one_worker_a_task(spark):
    """The last pass finds posteriors and rates in one function."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mix.stage(spark, docs, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_workers_get_a_few_mb_of_texts_at_a_time(spark):
    key, row = "spark.sql.execution.arrow.maxBytesPerBatch", 4400
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), row // 11).alias("text"))

    def rows(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)]})

    spark.conf.unset(key)
    packing.pieces(docs, public_tokenizer())
    got = [r["n"] for r in docs.mapInPandas(rows, "n long").collect()]
    assert sum(got) == 4000 and max(got) * row < 2 * BATCH_BYTES
    try:  # a bound that the session has stays
        spark.conf.set(key, "1m")
        packing.pieces(docs, public_tokenizer())
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_rules_query_covers_every_document(spark):
    sf = "/root/testdata/sf0.001"
    assert rules.op3_line_rules(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").agg(F.count("*")).first()[0]


def test_rules_hand_back_no_text(spark, odd):
    # whole texts used to come back from the workers, in blocks of 10,000 rows
    kinds = [f.dataType.simpleString() for f in rules.judged(odd).schema["judged"].dataType]
    assert "string" not in kinds
    prose = [" ".join(f"word{k + i}" for i in range(40)) + ", and so on." for k in (0, 100)]
    texts = [f"{prose[0]}\nhome | news | sport | more\n\n{prose[1]}\n", "\n".join(prose)] * 1100
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in rules.stage(spark, docs, "").collect()}
    want = [rules.judge(t)[9] for t in texts[:2]]
    assert want[0] != texts[0]
    assert got == {i: (want[i % 2], len(want[i % 2])) for i in range(len(texts))}
