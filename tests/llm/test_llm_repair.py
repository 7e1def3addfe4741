"""Importance resampling, repeated passages, and conversation repair against
brute force, with odd input."""

import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op11_resampling as resampling
from tidemark.llm import op12_substrings as substrings
from tidemark.llm import op13_conversations as talks
from tidemark.llm.fm_index import FMIndex
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


def none(df):
    return df.where("false")


@pytest.mark.parametrize("module, name", [(resampling, "op11_resampling"), (substrings, "op12_substrings"), (talks, "op13_conversations")])
def test_query_against_its_sql(spark, module, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = getattr(module, name)(spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(module.SQL)
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(got) == len(want) > 0
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


# -- importance resampling -----------------------------------------------------

def brute_resampling(docs, target, p):
    """(doc_id, n_words, n_features, weight, score, rank) by plain loops."""
    def words(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def feats(text):
        w = words(text)
        return [" ".join(w[i : i + k]) for k in range(1, p.words + 1) for i in range(len(w) - k + 1)]

    def histogram(texts):
        h = [0] * p.buckets
        for t in texts:
            for f in feats(t):
                h[zlib.crc32(f.encode()) % p.buckets] += 1
        return h

    s, t = histogram(x for _, x in docs), histogram(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + p.buckets) / ((a + 1) * (sum(t) + p.buckets)))) for a, b in zip(s, t)]
    out = []
    for i, x in docs:
        f = feats(x)
        w = sum(gain[zlib.crc32(a.encode()) % p.buckets] for a in f)
        h = int(hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words(x)), len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= p.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(fit) * p.percent // 100
    for r in out:
        r.append(None)
    for k, r in enumerate(fit[:drawn]):
        r[5] = k + 1
    return out


def table_of(r):
    return sorted((tuple(x) for x in r), key=str)


@pytest.mark.parametrize("p", [resampling.Resampling(min_words=3, percent=40), resampling.Resampling(words=3, buckets=64, min_words=1, percent=100)])
def test_resampling_against_brute_force(spark, p):
    rng = random.Random(3)
    vocab = ["Apple", "pear", "Zürich", "x1", "日本", "a_b", "it's", "\x00q", "E=mc2", " nb"]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 30)))) for i in range(60)]
    docs += [(7, docs[7][1]), (7, docs[7][1]), (None, "apple pear apple pear"), (None, None), (70, ""), (71, " \n\t"), (-5, "pear " * 5000)]
    target = ["apple x1 pear", None, "", "日本 zürich"]
    df = spark.createDataFrame([(i, t, "clash", 1, 2, 3, 4) for i, t in docs],
                               "doc_id long, text string, rank string, bins int, n_words int, __row int, __at int").repartition(3)
    tf = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resampled(df, tf, p).collect()
    assert table_of(got) == table_of(brute_resampling(docs, target, p))
    none_wanted = resampling.resampled(df, none(tf), p).collect()
    assert table_of(none_wanted) == table_of(brute_resampling(docs, [], p))
    assert resampling.resampled(none(df), tf, p).count() == 0


def test_resampling_takes_words_from_the_pre_tokeniser():
    text = "Don't STOP, Ünï-code x 12\x7fab"
    found = resampling.splitter().pre_tokenize_str(resampling.lowered(text))
    assert [w for w, _ in found] == re.findall(resampling.WORD_CLASS, resampling.lowered(text))
    assert all(resampling.lowered(text)[a:b] == w for w, (a, b) in found)
    assert resampling.features(found, 2)[-1] == " ".join(w for w, _ in found[-2:])


# -- repeated passages ---------------------------------------------------------

def brute_statistics(rows, patterns, cap):
    text = [x for r in rows for x in [*r, 0]]
    length, first = [], []
    for p in patterns:
        for i in range(len(p)):
            best, at = 0, -1
            for j in range(len(text)):
                k = 0
                while k < cap and i + k < len(p) and text[j + k] != 0 and text[j + k] == p[i + k]:
                    k += 1
                best = max(best, k)
                at = j if k == cap and at < 0 else at
            length.append(best)
            first.append(at)
    return length, first


def test_matching_statistics_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sigma, cap = int(rng.integers(2, 8)), int(rng.integers(1, 7))
        rows = [rng.integers(1, sigma, rng.integers(0, 15)) for _ in range(rng.integers(1, 8))]
        known = {0, *(int(x) for r in rows for x in r)}
        if len(known) == 1:
            continue
        others = [rng.integers(0, sigma, rng.integers(0, 15)) for _ in range(3)]
        patterns = [np.array([x if int(x) in known else 0 for x in p], np.int64) for p in others] + rows
        length, first = FMIndex(rows, sigma, cap).matching_statistics(patterns)
        assert (length.tolist(), first.tolist()) == brute_statistics(rows, patterns, cap)


def brute_substrings(docs, window):
    order = sorted({(i is None, i or 0, t or "") for i, t in docs})
    # texts of one id come in the order of a digest that is not known here
    assert len({o[:2] for o in order}) == len(order)
    seen, kept = set(), {}
    for none_, i, t in order:
        w, gone = t.encode().split(), set()
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            if k in seen:
                gone.update(range(a, a + window))
            seen.add(k)
        kept[none_, i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone))
    return [(i, n, g, hashlib.sha256(k).hexdigest(), k.decode()) for i, t in docs for n, g, k in [kept[i is None, i or 0]]]


PASSAGE = " ".join(f"p{i}" for i in range(30))


@pytest.mark.parametrize("p", [
    substrings.Repeats(window=5, anchor=2, shard_words=60, table_bits=10),
    substrings.Repeats(window=5, anchor=5, shard_words=10**6, table_bits=6),
    substrings.Repeats(window=6, anchor=1, shard_words=50, route_segments=3, table_bits=12),
    substrings.Repeats(window=4, anchor=3, shard_words=50, route_segments=0, table_bits=8),
    substrings.Repeats(),
])
def test_substrings_against_brute_force(spark, p):
    rng = random.Random(11)
    docs = []
    for i in range(120):
        words = [rng.choice("abcdefg") if i % 3 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 60))]
        if i % 2:  # one passage with as many surroundings
            words[rng.randint(0, len(words)) :] += PASSAGE.split()
        docs.append((i * 7 - 50, rng.choice(["  ", "\n", " "]).join(words)))
    docs += [(2000 + i, PASSAGE + " tail end of it all") for i in range(40)]  # copies
    docs += [(3000, "x " * 3000), (3001, None), (3002, ""), (3003, " \t\n"), (3004, "Ünï cödé \x1c one"), (3005, "y" * 9000 + " z"),
             (3006, "y" * 9000 + " z " + PASSAGE), (None, PASSAGE.replace(" ", "\x0b")), docs[3], docs[3], docs[121]]
    df = spark.createDataFrame([(i, t, "clash", 1, 2, 3, 4) for i, t in docs],
                               "doc_id long, text string, h string, none int, doc int, start int, spans int").repartition(3)
    got = substrings.without_repeats(df, p).collect()
    assert table_of(got) == table_of(brute_substrings(docs, p.window))
    assert substrings.without_repeats(none(df), p).count() == 0


def test_texts_of_one_id_are_ordered(spark):
    df = spark.createDataFrame([(1, PASSAGE + " one"), (1, PASSAGE + " two"), (2, PASSAGE)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_removed"]) for r in substrings.without_repeats(df).collect())
    assert got == [(1, 0), (1, 30), (2, 30)]


def test_segments_cover_every_window_once():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 80))).encode() for _ in range(50)]
    p = substrings.Repeats(window=7, anchor=3)
    w = substrings.Words(texts)
    s = substrings.Segments(w, p)
    windows = [a + k for a, n in zip(s.begin, s.words) for k in range(n - p.window + 1)]
    want = [a for a in range(len(w) - p.window + 1) if w.text[a] == w.text[a + p.window - 1]]
    assert windows == want and s.words.max() <= 2 * p.window - p.anchor
    # equal windows have one anchor digest, and never share a segment
    place, key = {}, {}
    for a, n, k in zip(s.begin.tolist(), s.words.tolist(), s.key.tolist()):
        for b in range(a, a + n - p.window + 1):
            text = tuple(w.raw[w.begin[c] : w.end[c]] for c in range(b, b + p.window))
            assert key.setdefault(text, k) == k and (text, a) not in place
            place[text, a] = b


# -- conversations -------------------------------------------------------------

def brute_repair(rows):
    """(cost, audit) as the least pair over all ways, row by row."""
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, ""))
        else:
            ini, fault = rows[i]
            extra = fault == "truncated"
            ways.append((3, "D", best(i + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                ways.append((2 + extra, "R", best(i + 1, turn[state], 0)))
                if ini == turn[state] or (ini == "s" and state == ""):
                    ways.append((extra, "K", best(i + 1, ini, 0)))
        if inserts < 2:
            ways.append((2, "I", best(i, turn[state], inserts + 1)))
        flat = [w if len(w) == 2 else (w[0] + w[2][0], w[1] + w[2][1]) for w in ways]
        return min(flat) if flat else (10**9, "")

    return best(0, "", 0)


def test_run_length_programme_against_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        rows = []
        while len(rows) < rng.randint(0, 12):
            rows += [(rng.choice("suax"), rng.choice(["", "", "blank", "truncated", "duplicate"]))] * rng.choice([1, 1, 2, 4])
        symbol = [talks.GONE if f in ("blank", "duplicate") else "suax".index(i) + 4 * (f == "truncated") for i, f in rows]
        runs = []
        for s in symbol:
            if runs and runs[-1][0] == s:
                runs[-1] = (s, runs[-1][1] + 1)
            else:
                runs.append((s, 1))
        assert talks.repaired(runs) == brute_repair(tuple(rows))


def test_long_runs_take_few_steps():
    cost, audit = talks.repaired([(1, 100_000), (2, 1)])
    assert cost == 2 * 50_000 and len(audit.replace("I", "")) == 100_001 and audit.startswith("KIKR")
    assert len(talks._POWERS[1]) <= 18


def brute_conversations(rows):
    crc = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    by = {}
    for c, t, role, text in rows:
        own = by.setdefault(c, [])
        d, role, text = crc(c, t), " " if role is None else role, " " if text is None else text
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        own += [(t is not None, t or 0, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = []
    for c, own in by.items():
        own.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        faults, seen = [], set()
        for _, _, role, text in own:
            tail = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "" if tail in ".!?" else "truncated")
            seen.add((role, text))
        ini = [r[2][:1] for r in own]
        cost, audit = brute_repair(tuple(zip([i if i and i in "sua" else "x" for i in ini], faults)))
        lines, state, at = [], "", 0
        nxt = {"": "user", "s": "user", "u": "assistant", "a": "user"}
        for e in audit:
            if e == "I":
                lines.append(f"{nxt[state]}:")
                state = nxt[state][0]
                continue
            _, _, role, text = own[at]
            at += 1
            if e == "K":
                lines.append(f"{role}:{text}")
                state = role[0]
            elif e == "R":
                lines.append(f"{nxt[state]}:{text}")
                state = nxt[state][0]
        turns = [r[1] for r in own if r[0]]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def test_conversations_against_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for c in range(80):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"])
            text = rng.choice(["Hi.", "What", "", None, " \n", "Yes!\t", "No? ", f"{t}.", "日本", "a.b"])
            rows.append((c, rng.choice([t, t, t + 3, None, -t]), role, text))
    rows += [(None, None, None, None), (None, 1, "user", "Hello."), (500, None, "user", "x"), (500, None, "user", "x"), (2**60 + 1, 2**61, "system", "S.")]
    rows += [(900, 5, "user", "again.")] * 30 + rows[:7]
    rows += [(901, i // 2, ["user", "assistant"][i % 3 == 0], f"{i % 50}.") for i in range(700)]  # over several tasks
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows],
                               "conv_id long, turn long, role string, text string, cid string, pos int, kind int").repartition(4)
    got = talks.repaired_conversations(df, talks.damaged(df)).collect()
    assert table_of(got) == table_of(brute_conversations(rows))
    assert talks.repaired_conversations(none(df), talks.damaged(none(df))).count() == 0


def test_conversations_without_damage(spark):
    df = spark.createDataFrame([("x", 1, "assistant", "Yes."), ("x", 2, "user", "And?"), ("y", 1, "user", "Go"), ("y", 2, "user", "Go")],
                               "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: r for r in talks.repaired_conversations(df, talks.plain(df)).collect()}
    assert got["x"]["cost"] == 4 and got["y"]["duplicate"] == 1 and got["y"]["truncated"] == 1
    assert all(r["repaired_sha256"] and set(r["audit"]) <= set("DIKR") for r in got.values())


def test_every_original_conversation_is_there(spark):
    t = spark.read.parquet(f"{SF}/conversations.parquet")
    assert talks.op13_conversations(spark, SF).count() == t.agg(F.countDistinct("conv_id")).first()[0]


# -- token ids and groups of documents ----------------------------------------

def test_ids_equal_the_library_on_texts_of_pieces(monkeypatch):
    from tidemark.llm import encode

    monkeypatch.setattr(encode, "MEMO_PIECES", 200)  # the table is cut down again and again
    monkeypatch.setattr(encode, "BLOCK", 500)
    e = encode.Encoder(encode.public_tokenizer())
    rng = random.Random(9)
    marks = ["", ".", ",", "!", "?!", "'s", "’", "…", ":"]
    for _ in range(150):
        texts = []
        for _ in range(8):
            words = ["".join(rng.choices("abcÉéßñ÷×ªЖ中'-2", k=rng.randint(1, 9))) + rng.choice(marks) for _ in range(rng.randint(1, 30))]
            texts.append("".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words)[:-1])
            texts.append("".join(rng.choices(["a", "b.", " ", " ", "\n", "\t", "\xa0", " ", "　", "<|endoftext|>", "\x1c", "é"], k=rng.randint(0, 12))))
        texts += [None, "", "x" * 300 + " " + "y" * 70]
        want = [np.array(e.library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert e.ids(texts) == want
    assert len(e.known) <= 200


def test_groups_are_of_documents(spark):
    from tidemark.llm import op5_packing as packing

    docs = spark.createDataFrame([(i, "word " * (300 if i % 7 == 0 else 20), 0) for i in range(200)] + [(7, "again and again", 1)] * 100
                                 + [(999, "long " * 9000, 2)], "doc_id long, text string, row int").repartition(3)
    got = packing.packed(docs, sequence=64, group_pieces=40).collect()
    groups = {}
    for r in got:
        groups.setdefault((r["doc_id"], r["start"] // (64 * 40)), set()).add(r["sequence_id"] >> 32)
    assert all(len(g) == 1 for (i, _), g in groups.items() if i != 7)  # 7 is many documents
    assert len(groups[7, 0]) > 1 and len({k for k in groups if k[0] == 999}) > 1
    size = {}
    for r in got:
        size[r["sequence_id"] >> 32] = size.get(r["sequence_id"] >> 32, 0) + 1
    assert max(size.values()) <= 4 * 40


# -- licenses by conditional compression ---------------------------------------

def everywhere(scanner, text):
    """Every template at every place: (license, differing words, characters)
    of the spans that no better one overlaps."""
    from tidemark.llm import op9_licenses as lic

    places = [m.span() for m in lic._WORD.finditer(text)]
    have = [lic.word(text[a:b]) for a, b in places]
    found = set()
    for k in range(len(scanner.templates)):
        for a in range(len(have)):
            f = scanner.confirmed(have, *scanner.reach(a, k, len(have)), k, a)
            if f is not None:
                found.add((*f, scanner.templates[k][0]))
    return have, found


def test_ranking_by_compression_loses_no_notice():
    from tidemark.llm import op9_licenses as lic

    scanner = lic.Scanner()
    rng = random.Random(6)
    filler = "the of and a to we build boats in harbour town every spring when water is high then paint them again".split()
    for _ in range(60):
        text, planted = [], 0
        for _ in range(rng.randint(1, 3)):
            _, needs, notice = rng.choice(lic.TEMPLATES)
            words, keep = notice.split(), set(needs.split())
            for i in range(len(words)):  # few words changed, none that the license needs
                if rng.random() < 0.05 and not keep & set(lic.words(words[i])) and len(words) > 8:
                    words[i] = rng.choice(filler)
            text += rng.choices(filler, k=rng.randint(3, 40)) + words
            planted += 1
        block = " ".join(text + rng.choices(filler, k=5))
        _, want = everywhere(scanner, block)
        got = scanner.scan(block)
        places = [m.span() for m in lic._WORD.finditer(block)]
        spans = [(a, a + n) for a, n, *_ in got]
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        # whatever any template states anywhere lies on a reported notice
        for different, first, last, name in want:
            a, b = places[first][0], places[last - 1][1]
            assert any(x < b and a < y for x, y in spans), (name, block[a:b])
        # and an exact notice is reported as one, unless a longer one holds it
        for different, first, last, name in want:
            if different == 0:
                a, b = places[first][0], places[last - 1][1]
                assert any(n == name and d == 0 and x <= a and b <= x + m or x < b and a < x + m and m >= b - a
                           for x, m, n, d, _ in got), (name, block[a:b], got)


def test_ranks_decide_which_pairs_are_compared(monkeypatch):
    from tidemark.llm import op9_licenses as lic

    scanner = lic.Scanner()
    text = next(t for n, _, t in lic.TEMPLATES if n == "GPL-3.0" and len(t) > 150)
    pairs = scanner.pairs([lic.word(w) for w in lic._WORD.findall(text)])
    assert scanner.templates[pairs[0][1]][0] == "GPL-3.0" and len(scanner.templates[pairs[0][1]][2]) > 30
    compared = []
    plain = lic.Scanner.confirmed
    monkeypatch.setattr(lic.Scanner, "confirmed", lambda self, have, lo, hi, k, a: compared.append(k) or plain(self, have, lo, hi, k, a))
    assert [r[2] for r in scanner.scan(text)] == ["GPL-3.0"]
    assert len(compared) < len(pairs) and compared[0] == pairs[0][1]


@pytest.mark.parametrize("text, want", [
    ("Released under the MIT Licence.", "MIT"), ("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
    ("Distributed under the terms of the MIT license.", "MIT"), ("This project is MIT licensed.", "MIT"),
    ("MIT License\n\nCopyright (c) 2020 A. Person", None), ("MIT License\nCopyright (c) 2020 A. Person", "MIT"),
    ("Licensed under the EUPL, Version 1.2.", "EUPL-1.2"), ("My driving licence was renewed.", None), ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0"),
])
def test_forms_of_notices(text, want):
    from tidemark.llm import op9_licenses as lic

    scanner = lic.Scanner()
    got = [r[2] for _, _, block in lic.blocks(text) for r in scanner.scan(block)]
    assert got == ([want] if want else [])


# -- main text of pages ----------------------------------------------------------

def splits(tree):
    return set() if isinstance(tree, bool) else {tree[0]} | splits(tree[2]) | splits(tree[3])


def test_the_tree_decides_by_neighbours():
    from tidemark.llm import op8_html_text as html

    used = {html.FEATURES[f] for f in splits(html.trained())}
    assert {"words before", "words after"} <= used and used & {"density before", "density after"}
    x, y = html.labelled_table()
    near = [i for i, f in enumerate(html.FEATURES) if "before" in f or "after" in f]
    own = [i for i in range(len(html.FEATURES)) if i not in near]
    with_them = (html.classify(html.trained(), x) == y).mean()
    alone = html.grow(x[:, own], y)
    assert with_them > 0.99 and with_them - (html.classify(alone, x[:, own]) == y).mean() > 0.01
    # one block, other neighbours
    prose = "The path goes on along the water for a mile and then turns to the hills, where the wind is strong. " * 3
    links = "<ul><li><a href=1>One page</a></li><li><a href=2>Another</a></li></ul>"
    kept, gone = (f"<body>{links}<p>{prose}</p><p>Open all year to every visitor</p>{after}</body>" for after in (f"<p>{prose}</p>{links}", links))
    assert "Open all year to every visitor" in html.main_text(kept) and "Open all year to every visitor" not in html.main_text(gone)


def test_blocks_and_features_against_brute_force():
    from tidemark.llm import op8_html_text as html

    rng = random.Random(4)
    for _ in range(60):
        want, page = [], "<body>"
        for _ in range(rng.randint(1, 12)):
            words = rng.choices(["a", "b.", "été", "c?", "d,"], k=rng.randint(1, 8))
            linked = rng.randint(0, len(words))
            boiler, heading, tag = rng.random() < 0.3, rng.random() < 0.2, rng.choice(["p", "div", "li", "td"])
            tag = "h2" if heading else tag
            inner = "<a href='x'>" + rng.choice([" ", "\n "]).join(words[:linked]) + "</a> " + "  ".join(words[linked:])
            page += f"<div class='{'sidebar' if boiler else 'x1'}'><{tag}>{inner}</{tag}></div>"
            want.append([" ".join(words), len(words), linked, boiler, 0, heading])
        got = html.blocks_of(page + "</body>")
        assert [b[:6] for b in got] == want
        x = html.features(got)
        for i, b in enumerate(want):
            def three(j):
                if not 0 <= j < len(want):
                    return [0, 0, 0]
                return [want[j][1], want[j][2] / want[j][1], sum(w[-1] in ".?" for w in want[j][0].split())]

            context = html.BOILER if b[3] else html.UNMARKED
            assert x[i].tolist() == [*three(i), *three(i - 1), *three(i + 1), b[5], context]


@pytest.mark.parametrize("part, want", [
    ("<p>One is here.<button>Share</button> And two.</p>", "One is here. And two."),
    ("<p>One is here.<button>Share<p>Two is here too.</p>", "One is here.\n\nTwo is here too."),
    ("<p>One.<svg><title>x</title><path></svg> Two.</p>", "One. Two."),
    ("<p>One.<svg><path><p>Two.</p>", "One.\n\nTwo."),
    ("<p>Pick <select><option>a<option>b</select> one.</p>", "Pick one."),
    ("<p>Energy is <math>E=mc2</math> as known.</p>", "Energy is E=mc2 as known."),
    ("<p>One.<iframe src=x></iframe> Two.</p>", "One. Two."),
    ("<script>var a = '<p>no</p>'</script><p>One.</p><style>p{}</style>", "One."),
])
def test_elements_without_text(part, want):
    from tidemark.llm import op8_html_text as html

    assert html.main_text(f"<article><h1>Head of it</h1>{part}<p>The last one ends the page.</p></article>") == (
        f"Head of it\n\n{want}\n\nThe last one ends the page.")


# -- nearest neighbours among repeated rows --------------------------------------

def test_ann_of_repeated_rows(spark, monkeypatch):
    from tidemark.llm import op2_ann as ann

    monkeypatch.setattr(ann, "FAN", 3)  # lists are joined in several steps
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 12))
    p = ann.Ann(k=10, sample_rows=300, leaf_rows=16, block_rows=20, calibration=20)
    once = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    often = once.withColumn("again", F.explode(F.array(*map(F.lit, range(8))))).drop("again").repartition(5)
    results = []
    for d in (once, often):
        got = {}
        for r in ann.search(d, d.where("vec_id % 20 = 0"), p).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        hit = 0
        for q, found in got.items():
            s = (x * x[q]).sum(1)
            s[q] = -np.inf
            assert [k for k, _ in sorted(found)] == list(range(1, 11)) and len({v for _, v in found}) == 10
            hit += len({v for _, v in found} & set(np.argsort(-s)[:10].tolist()))
        results.append(hit / (10 * len(got)))
    assert min(results) >= 0.9


# -- ids with several texts, columns of any name --------------------------------

def test_an_id_with_several_texts_links_them(spark):
    from tidemark.llm import op10_ngram_join as ngram

    t1, t2, t3 = (" ".join(f"{p}{i}" for i in range(60)) for p in "xyz")
    docs = [(1, t1), (5, t1), (5, t2), (3, t2), (4, t3), (7, t3), (8, "short"), (9, None), (9, "more words than one or two here")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram.linked(d).collect()}
    assert got == {1: 1, 3: 1, 5: 1, 4: 4, 7: 4, 8: 8, 9: 9}
    # the stage removes copies, not the other texts of their ids
    kept = sorted((r["doc_id"], r["text"]) for r in ngram.stage(spark, d, "").collect() if r["doc_id"] != 9)
    assert kept == sorted([(1, t1), (3, t2), (4, t3), (8, "short")])


def test_one_text_very_often(spark):
    from tidemark.llm import op10_ngram_join as ngram

    text = " ".join(f"w{i}" for i in range(50))
    d = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).repartition(4)
    near = spark.createDataFrame([(20_000, text + " more"), (20_001, "another text of its own altogether")], "doc_id long, text string")
    got = ngram.linked(d.unionByName(near))
    assert got.groupBy("component_id").count().collect()[0]["count"] in (10_001, 1)
    assert {r["component_id"]: r["count"] for r in got.groupBy("component_id").count().collect()} == {0: 10_001, 20_001: 1}


CLASHES = ["h", "doc", "gone", "at", "row", "own", "own_doc", "own_h", "rate", "digest", "posterior", "copies", "use", "__mix", "__use",
           "__judged", "_judged", "__removed", "key", "cls", "gone_id", "gone_h", "__id", "quality", "n_tokens"]


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    wide = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        bad = F.lit(False)
        for c in CLASHES:
            bad = bad | ~F.col(f"`{c}`").eqNullSafe(F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")))
        assert out.where(bad).isEmpty() and not out.isEmpty(), name


def test_plans_of_line_dedup_hold_no_table(spark, monkeypatch):
    """The rarity table is read where it is used: no plan holds its bytes, and
    it is no column of any row."""
    from tidemark.llm import op7_line_dedup as lines

    plans = []
    plain = lines.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(lines, "stored", seen)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines.deduplicated(docs.select("doc_id", "text")).count()
    using = [p for p in plans if "Subquery" in p]
    assert len(plans) > 8 and using and max(map(len, plans)) < 40_000
    # no operator gives the table on as a column
    assert not any("AS levels" in p for p in using)
