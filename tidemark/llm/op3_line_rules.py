"""Line-first quality rules.

Every line is judged by itself (punctuation, navigation and boilerplate
rules); failing lines are removed; a document that loses too much of its text
is rejected.  The base counts (words, symbols, repeated lines and windows) are
taken on the whole text as it came.

Defined results: a null or blank text has no words, so it fails the base rule;
blank lines are never judged; repeated rows and null ids are judged row by row;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import WORD_RE, fresh, small_batches, table

SYMBOLS = "#*$%&|<>"
_SYMBOL_WORD = re.compile(r"[^\x20\x09-\x0D]*[#*$%&|<>][^\x20\x09-\x0D]*")
_SEPARATOR = re.compile(r"(?:^|[\x20\x09-\x0D])[|>/•·»](?=[\x20\x09-\x0D]|$)")
_SHOUT = re.compile(r"[!?]{2,}")
_UPPER = re.compile(r"[A-Z]")
_LOWER = re.compile(r"[a-z]")
_PUNCTUATION = re.compile(r"[.,;:!?…]")
BOILERPLATE = (
    "accept (all )?cookies|uses cookies|cookie (policy|settings)|privacy policy|terms of (use|service)|"
    "all rights reserved|subscribe to our|sign up for our|newsletter|log in to|javascript is (disabled|required)|"
    "click here|share (this|on)|skip to (main )?content|powered by|read more|back to top"
)
_BOILERPLATE = re.compile(rf"(?:^|[^a-z])(?:{BOILERPLATE})(?:[^a-z]|$)")


@dataclass(frozen=True)
class LineRules:
    """Thresholds.  Shares are in percent, so that every rule is exact integer
    arithmetic."""

    min_words: int = 10  # base: fewer words fail
    max_repeat_pct: int = 20  # base: words in repeated 5-word windows
    rule_words: int = 4  # shorter lines are judged by phrases only
    symbol_pct: int = 30  # words that carry a symbol
    shout_pct: int = 30  # runs of ! or ? per word
    separator_words: int = 4  # navigation: a separator per so many words
    unpunctuated_words: int = 12  # so many words without any punctuation
    repeat_pct: int = 30  # words equal to the word before
    boilerplate_words: int = 25  # a boilerplate phrase in a line up to this long
    max_lost_pct: int = 30  # word characters in failing lines


def line_fails(line: str, words: list[str], r: LineRules = LineRules()) -> bool:
    """Whether one line fails.  A line without words never does."""
    n = len(words)
    if n == 0:
        return False
    if n >= r.rule_words:
        if 100 * len(_SYMBOL_WORD.findall(line)) > r.symbol_pct * n:
            return True
        if 100 * len(_SHOUT.findall(line)) > r.shout_pct * n:
            return True
        if len(_UPPER.findall(line)) > 2 * len(_LOWER.findall(line)):
            return True
        if sum(a == b for a, b in zip(words, words[1:])) * 100 > r.repeat_pct * n:
            return True
        seps = len(_SEPARATOR.findall(line))
        if seps >= 3 and n <= r.separator_words * seps:
            return True
        if n >= r.unpunctuated_words and not _PUNCTUATION.search(line):
            return True
    return n <= r.boilerplate_words and bool(_BOILERPLATE.search(_ascii_lower(line)))


_LOWER_TABLE = {c: c + 32 for c in range(65, 91)}


def _ascii_lower(s: str) -> str:
    return s.lower() if s.isascii() else s.translate(_LOWER_TABLE)


def repeated_window_words(words: list[str], size: int = 5) -> int:
    """Words that lie in a window of ``size`` words found twice or more.

    Exact: windows are compared by word numbers, packed into one integer where
    they fit and renumbered pairwise where they do not.
    """
    n = len(words)
    if n <= size:
        return 0
    number: dict[str, int] = {}
    a = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    if v == n:
        return 0
    if v**size < 2**62:
        key = np.zeros(n - size + 1, np.int64)
        for i in range(size):
            key = key * v + a[i : n - size + 1 + i]
    else:
        key = a
        for i in range(1, size):  # key: windows of i words; append one word
            _, key = np.unique(key[: n - i], return_inverse=True)
            key = key * v + a[i:]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inverse] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def verdict(text: str | None, r: LineRules = LineRules()) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_lines_removed, lost_chars, of every line whether it fails; empty if
    none does)."""
    text = text or ""
    words: list[str] = []
    seen: set[str] = set()
    failing: list[bool] = []
    dup = removed = lost = 0
    for line in text.split("\n"):
        failing.append(False)
        own = WORD_RE.findall(line)
        if own:
            dup += line in seen
            seen.add(line)
            words += own
            if line_fails(line, own, r):
                failing[-1] = True
                removed += 1
                lost += sum(map(len, own))
    n, chars = len(words), sum(map(len, words))
    repeat = repeated_window_words(words)
    failed = n < r.min_words or 100 * repeat > r.max_repeat_pct * n
    kept = not failed and 100 * lost <= r.max_lost_pct * chars
    return (n, chars, sum(map(text.count, SYMBOLS)), dup, repeat, failed, kept, removed, lost, failing if removed else [])


def judge(text: str | None, r: LineRules = LineRules()) -> tuple:
    """As :func:`verdict`, with the text without its failing lines as the last."""
    *counts, failing = verdict(text, r)
    return *counts, "\n".join(x for x, bad in zip((text or "").split("\n"), failing) if not bad) if failing else text or ""


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "n_lines_removed", "lost_chars", "failing")
_TYPES = ("long",) * 5 + ("boolean",) * 2 + ("long",) * 2 + ("array<boolean>",)
#: Rows that a worker judges and hands back at a time.
_BLOCK = 1000


def judged(docs: DataFrame, rules: LineRules = LineRules(), text_col: str = "text", out: str = "judged") -> DataFrame:
    """``docs`` with a struct column ``out`` holding :func:`verdict` of each text.
    No text comes back from the workers: :func:`cleaned` makes it from the row's."""

    @pandas_udf(", ".join(f"{a} {b}" for a, b in zip(_FIELDS, _TYPES)))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            for at in range(0, len(texts), _BLOCK):
                yield pd.DataFrame([verdict(t, rules) for t in texts.iloc[at : at + _BLOCK]], columns=list(_FIELDS))

    small_batches(docs.sparkSession)
    # marked so that a filter on the struct and a read of it run the function once
    return docs.withColumn(out, run.asNondeterministic()(F.col(text_col)))


def cleaned(text, failing) -> Column:
    """A text without the lines marked as failing."""
    good = F.filter(F.split(text, "\n", -1), lambda x, at: ~F.get(failing, at))
    return F.when(F.size(failing) > 0, F.array_join(good, "\n")).otherwise(text)


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = judged(docs)
    return j.select("doc_id", *(f"judged.{f}" for f in _FIELDS if f != "failing"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, failing lines leave the kept ones."""
    cols = list(docs.columns)
    own = fresh(docs, "__judged")
    j = judged(docs, out=own).where(F.col(own)["kept"]).withColumn("text", cleaned(F.col("text"), F.col(own)["failing"]))
    return j.withColumn("n_chars", F.char_length("text").cast("long")).select(cols)


#: DuckDB: per line of a list column ``ws`` of words and the line itself.
_W = r"[^\x20\x09-\x0D]+"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{_W}') AS ws FROM d),
l0 AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
l1 AS (SELECT *, regexp_extract_all(line, '{_W}') AS ws FROM l0),
l2 AS (SELECT *, len(ws) AS n, row_number() OVER (PARTITION BY rid, line ORDER BY i) AS nth,
        list_sum(list_transform(ws, lambda x: length(x))) AS chars FROM l1 WHERE len(ws) > 0),
l3 AS (SELECT *,
  (n >= 4 AND (
     100 * len(regexp_extract_all(line, '[^\x20\x09-\x0D]*[#*$%&|<>][^\x20\x09-\x0D]*')) > 30 * n
  OR 100 * len(regexp_extract_all(line, '[!?]{{2,}}')) > 30 * n
  OR len(regexp_extract_all(line, '[A-Z]')) > 2 * len(regexp_extract_all(line, '[a-z]'))
  OR 100 * len(list_filter(range(1, n), lambda j: ws[j] = ws[j + 1])) > 30 * n
  OR (len(list_filter(ws, lambda x: x IN ('|', '>', '/', '•', '·', '»'))) >= 3
      AND n <= 4 * len(list_filter(ws, lambda x: x IN ('|', '>', '/', '•', '·', '»'))))
  OR (n >= 12 AND NOT regexp_matches(line, '[.,;:!?…]'))))
  OR (n <= 25 AND regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '(?:^|[^a-z])(?:{BOILERPLATE})(?:[^a-z]|$)')) AS bad
  FROM l2),
ls AS (SELECT rid, sum((nth > 1)::INT) AS dup, sum(bad::INT) AS removed, sum(CASE WHEN bad THEN chars ELSE 0 END) AS lost
  FROM l3 GROUP BY rid),
v AS (SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
k AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(ws[i:i + 4], ' ')) AS c FROM v),
r AS (SELECT rid, count(DISTINCT i + o) AS rep FROM k, (SELECT unnest([0, 1, 2, 3, 4]) AS o) WHERE c > 1 GROUP BY rid),
b AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
  coalesce(rep, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS n_lines_removed, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM w LEFT JOIN ls USING (rid) LEFT JOIN r USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 30 * word_chars AS kept,
  n_lines_removed, lost_chars FROM b
"""
