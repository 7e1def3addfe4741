"""License scans by conditional compression.

Adjacent non-blank lines are a paragraph; adjacent paragraphs that hold a cue
word are a candidate, in which line breaks and comment marks count as spaces, so
a notice may be wrapped.  Of each candidate, the windows of a template's size
around its rarest required word are compressed, by themselves and with the
template as a zstandard raw dictionary.  The (window, template) pairs are ranked
by the bytes that the dictionary saves, and taken in that order: the first whose
wording confirms it (of equal ranks, the one with the fewest different words) wins
its words, and pairs that these leave no room are never compared.  Wording confirms a template if the exact word differences of the
window's best alignment are few and leave the required words alone.  No pair is
cut off by its saving, so the ranking decides between templates and never hides
a notice, whatever the length of the text around it.

Defined results: a null or blank text has no candidates and no rows; repeated
rows are scanned row by row; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

#: License names, the words a notice must hold (| parts an
#: alternative), and notices as they are commonly written.
TEMPLATES: list[tuple[str, str, str]] = [
    ("Apache-2.0", "apache license 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache license 2.0",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "mit license", "Released under the MIT License."),
    ("MIT", "permission granted free charge copy software",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "gnu general public license 3",
     "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gnu general public license 3",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("GPL-2.0", "gnu general public license 2",
     "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "gnu general public license 2",
     "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
     "later version."),
    ("LGPL-3.0", "gnu lesser general public license 3",
     "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "gnu affero general public license 3",
     "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "bsd 3", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "bsd 2", "Licensed under the BSD 2-Clause License."),
    ("BSD", "redistribution source binary forms permitted",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("MPL-2.0", "mozilla public license 2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "isc license", "Released under the ISC License."),
    ("Unlicense", "public domain", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "cc0", "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "cc by 4.0 !nc !sa !nd", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by sa 4.0 !nc !nd", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "cc by nc 4.0 !sa !nd", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "cc by nd 4.0 !nc !sa", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "cc by nc sa 4.0 !nd", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "cc by nc nd 4.0 !sa", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "creative commons attribution 4.0 !noncommercial !sharealike !noderivatives",
     "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "creative commons attribution sharealike 4.0 !noncommercial",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "creative commons attribution noncommercial 4.0 !sharealike !noderivatives",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]

#: How licenses are named in short notices: license, name, the
#: words that must be there.
NAMES = [
    ("MIT", "MIT", "mit"), ("Apache-2.0", "Apache 2.0", "apache 2.0"), ("GPL-3.0", "GPL 3.0", "gpl 3.0"), ("GPL-3.0", "GPLv3", "gplv3"),
    ("GPL-2.0", "GPL 2.0", "gpl 2.0"), ("GPL-2.0", "GPLv2", "gplv2"), ("LGPL-3.0", "LGPL 3.0", "lgpl 3.0"), ("AGPL-3.0", "AGPL 3.0", "agpl 3.0"),
    ("BSD-3-Clause", "BSD 3-Clause", "bsd 3"), ("BSD-2-Clause", "BSD 2-Clause", "bsd 2"), ("MPL-2.0", "MPL 2.0", "mpl 2.0"),
    ("ISC", "ISC", "isc"), ("EUPL-1.2", "EUPL 1.2", "eupl 1.2"),
]
#: Forms of short notices, and the license word each must hold.
FORMS = [
    ("Distributed under the terms of the {} license.", "license"),
    ("Licensed under the {} license.", "license"),
    ("Released under the {} license.", "license"),
    ("This project is {} licensed.", "licensed"),
]
#: License identifiers of the tag "SPDX-License-Identifier".
IDENTIFIERS = [
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC",
    "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EUPL-1.2", "Zlib",
]
_KNOWN = {text for _, _, text in TEMPLATES}
TEMPLATES += [(lic, f"{need} {word}", form.format(name)) for lic, name, need in NAMES for form, word in FORMS
              if form.format(name).lower() not in {t.lower() for t in _KNOWN}]
TEMPLATES += [(i, "spdx identifier " + " ".join(re.findall(r"\d+(?:\.\d+)*|[^\W\d_]+\d*", i.lower())) + (" !sa !nc !nd" if i == "CC-BY-4.0" else ""),
               f"SPDX-License-Identifier: {i}") for i in IDENTIFIERS]
TEMPLATES += [("MIT", "mit license copyright", "MIT License Copyright (c)"),
              ("EUPL-1.2", "eupl 1.2", "Licensed under the EUPL, Version 1.2.")]

#: Reaches only paragraphs that may hold a notice; runs inside the JVM.  Single
#: words, so a line break cannot part them; each template needs one of them.
CUE = r"(?i)licen[sc]e|\bCC0?\b|\bcommons\b|\bpermission\b|\bredistribution\b|\bdomain\b"
_CUE = re.compile(CUE)
#: What stands before the first word of a line, comment words included.
_MARK = re.compile(r"(?mi)^[^\w\n]+(?:(?:rem|dnl)\b[^\w\n]*)?|^(?:rem|dnl)\b[^\w\n]*")
_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+\d*")

#: A notice differs in at most this share of the template's words.
MAX_DIFFERENT = 0.25
#: Compression level of windows.
LEVEL = 9
#: Savings that differ by no more bytes are equal ranks (a window's other words
#: move them by that much); the wording decides between these.
EQUAL_BYTES = 6


def word(raw: str) -> str:
    """A word as it is compared: small letters, one spelling of "license"."""
    low = raw.lower()
    return low.replace("licence", "license") if low.startswith("licence") else low


def words(text: str) -> list[str]:
    return [word(w) for w in _WORD.findall(text)]


class Scanner:
    """The templates, prepared once per Python worker."""

    def __init__(self, templates=TEMPLATES):
        import zstandard

        self.templates = [(name, required.split(), words(text)) for name, required, text in templates]
        self.needed = [[r for r in required if r[0] != "!"] for _, required, _ in self.templates]
        self.counts = [Counter(want) for _, _, want in self.templates]
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.given = []
        for _, _, want in self.templates:
            d = zstandard.ZstdCompressionDict(" ".join(want).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.given.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d))

    def sizes(self, have: list[str], lo: int, hi: int, k: int) -> tuple[int, int]:
        """Bytes of the words from ``lo`` to ``hi``, compressed by themselves
        and with template ``k`` as dictionary."""
        raw = " ".join(have[lo:hi]).encode("utf-8", "surrogatepass")
        return len(self.alone.compress(raw)), len(self.given[k].compress(raw))

    def pairs(self, have: list[str]) -> list[tuple[int, int, int]]:
        """(bytes saved, template, place of its rarest required word) of every
        window that may state a template, best first."""
        at: dict[str, list[int]] = {}
        for i, w in enumerate(have):
            at.setdefault(w, []).append(i)
        out = []
        for k, needed in enumerate(self.needed):
            if any(r not in at for r in needed):
                continue
            for a in at[min(needed, key=lambda r: len(at[r]))]:
                alone, given = self.sizes(have, *self.reach(a, k, len(have)), k)
                out.append((alone - given, k, a))
        return sorted(out, key=lambda p: (-p[0], -len(self.templates[p[1]][2]), p[1], p[2]))

    def reach(self, a: int, k: int, n: int) -> tuple[int, int]:
        """The window of template ``k`` around word ``a`` of ``n``: wherever in
        the template that word may be."""
        wide = len(self.templates[k][2]) + int(MAX_DIFFERENT * len(self.templates[k][2])) + 2
        return max(0, a - wide), min(n, a + wide + 1)

    def confirmed(self, have: list[str], lo: int, hi: int, k: int, a: int) -> tuple[int, int, int] | None:
        """(differing words, first and last word of the match) if the words
        from ``lo`` to ``hi`` state template ``k`` at word ``a``: the exact
        alignment of both, cut to the run of aligned parts around ``a`` that
        differs least."""
        _, required, want = self.templates[k]
        most = MAX_DIFFERENT * len(want)
        # no alignment has more words in common than the two bags
        if len(want) - (Counter(have[lo:hi]) & self.counts[k]).total() > most:
            return None
        best = None
        # the alignment as the template has word a, each way, then of the window
        slack = int(most) + 2
        ways = [(max(lo, a - i - slack), min(hi, a - i + len(want) + slack)) for i, w in enumerate(want) if w == have[a]]
        for x, y in [*ways, (lo, hi)]:
            parts = [m for m in SequenceMatcher(None, want, have[x:y], autojunk=False).get_matching_blocks() if m.size]
            for i, m in enumerate(parts):
                same = 0
                for n in parts[i:]:
                    same += n.size
                    first, last = x + m.b, x + n.b + n.size
                    different = max(len(want), last - first) - same
                    if different <= most and first - 1 <= a <= last and (
                            best is None or (different, first - last, first) < (best[0], best[1] - best[2], best[1])):
                        near = set(have[max(0, first - 1) : last + 2])
                        if all((r[1:] not in near) if r[0] == "!" else (r in near) for r in required):
                            best = different, first, last
        return best

    def scan(self, block: str) -> list[tuple[int, int, str, int, float]]:
        """(first character, length, license, differing words, share saved) of
        every notice: pairs in the order of their ranks, each confirmed by its
        wording among the words that no better one has taken."""
        places = [m.span() for m in _WORD.finditer(block)]
        have = [word(block[a:b]) for a, b in places]
        free = [True] * len(have)
        out = []
        pairs = self.pairs(have)
        for i, (saved, k, a) in enumerate(pairs):
            best = self.placed(have, free, k, a)
            if best is None:
                continue
            for other, m, c in pairs[i + 1 :]:
                if saved - other > EQUAL_BYTES or not best[0]:
                    break
                rival = self.placed(have, free, m, c)
                if rival is not None and rival[1] < best[2] and best[1] < rival[2] and (rival[0], rival[1] - rival[2]) < (best[0], best[1] - best[2]):
                    best, k = rival, m
            different, first, last = best
            free[first:last] = [False] * (last - first)
            alone, given = self.sizes(have, first, last, k)
            x, y = places[first][0], places[last - 1][1]
            out.append((x, y - x, self.templates[k][0], different, 1 - given / alone))
        return sorted(out)

    def placed(self, have: list[str], free: list[bool], k: int, a: int) -> tuple[int, int, int] | None:
        """``confirmed`` among the free words around word ``a``."""
        if not free[a]:
            return None
        lo, hi = self.reach(a, k, len(have))
        while not all(free[lo:a]):
            lo += 1
        stop = a
        while stop < hi and free[stop]:
            stop += 1
        return self.confirmed(have, lo, stop, k, a)


def blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """(first character, length, block) of each candidate: the runs of
    paragraphs of which each holds a cue.  In the block, line breaks and comment
    marks are spaces, one for each character."""
    runs, at, start = [], 0, None  # paragraphs
    for line in [*text.split("\n"), ""]:
        if line.strip():
            start = at if start is None else start
        elif start is not None:
            runs.append((start, at - 1))
            start = None
        at += len(line) + 1
    first = None
    for a, b in [*runs, (len(text), len(text))]:
        if _CUE.search(text, a, b):
            first, last = a if first is None else first, b
        elif first is not None:
            block = _MARK.sub(lambda m: " " * len(m.group()), text[first:last]).replace("\n", " ")
            yield first, len(block.rstrip()), block.rstrip()
            first = None


_SCANNERS: list[Scanner] = []
_OUT = "doc_id long, block_start long, block_chars long, license string, n_different long, exact boolean, saved double"


def scan_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    if not _SCANNERS:
        _SCANNERS.append(Scanner())
    scanner = _SCANNERS[0]
    known: dict[str, list[tuple]] = {}
    names = [c.split()[0] for c in _OUT.split(", ")]
    for b in batches:
        rows = []
        for doc_id, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
            for start, _, block in blocks(text or ""):
                if block not in known:
                    if len(known) > 20_000:
                        known.clear()
                    known[block] = scanner.scan(block)
                rows += [(doc_id, start + a, n, name, different, different == 0, round(saved, 4))
                         for a, n, name, different, saved in known[block]]
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice: document, place, license, differing words, share of
    its compressed size that the template saves."""
    cued = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").rlike(CUE))
    return cued.mapInPandas(scan_texts, _OUT)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))
