"""Line deduplication by an exact set-similarity join.

A line is the set of its distinct words.  Its words are ordered by rarity, the
rarest first; two lines of Jaccard similarity s or more must then share a word
among their first n - ceil(s n) + 1 (prefix filter), at places that leave room
for enough common words (positional filter), and their sizes differ little
(length filter); a 64-bit sketch of each set bounds the difference from below.
The pairs left are verified exactly.  A line is removed when
an earlier one (by document id, then by place) equals or resembles it.

Only DataFrame functions are used.  A word is a 64-bit digest; its rarity is the
logarithm of the count of its digest's cell in a counting table of fixed size,
which covers all rows.  One number holds both, the rarity above 56 bits of the
digest, so sorting a line's numbers orders its words by rarity, the same way in
every line, without joining every word with its count.

Groups stay linear.  Lines of equal sets are joined first, so a line that stands
in very many documents is one row from there on.  Then each word's list of lines
ties its members to the list's first one, which settles the variants of a common
line; only lines not settled by that are joined with the whole lists.  Whole sets
are made again, from the text, for lines in a candidate pair only.

Defined results: blank lines are never removed, and lines of fewer than
``min_words`` distinct words only with ``short_copies``, if an earlier line has
the same distinct words; a null text has no lines and stays null;
rows of the same id and text are one document, and rows of one id with different
texts are ordered by a digest of the text; a null id comes last; an empty table
gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bit_table, fresh, has_bit, stored, table


@dataclass(frozen=True)
class Lines:
    percent: int = 90  # similarity
    #: Lines with fewer distinct words are compared with none.
    min_words: int = 5
    #: Whether such lines go if an earlier line has the same words; they stay,
    #: however often they occur, without it.
    short_copies: bool = False
    #: The counting table has 2^cell_bits cells, of a byte each.
    cell_bits: int = 20


#: The six white-space characters that part words.
_SPACES = " \t\n\x0b\x0c\r"
_BITS = 1 << 23


def text_lines(text) -> Column:
    return F.split(text, "\n", -1)


def keyed(docs: DataFrame) -> DataFrame:
    """doc, h (digest of the text), text: what names a document here."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("h"), "text")


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, h, at (place of the line), line.  Blank lines stay here: they have
    no words, and trimming every line costs more than splitting it."""
    return docs.select("doc", "h", F.posexplode(text_lines(F.col("text"))).alias("at", "line"))


def words_of(line) -> Column:
    """The digests of a line's distinct words."""
    # a split at one plain character needs no regular expression; lines with
    # other white space than spaces take the slower way
    odd = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c"))
    parts = F.when(odd, F.split(line, r"[\x20\x09-\x0D]+", -1)).otherwise(F.split(line, " ", -1))
    return F.array_remove(F.array_distinct(F.transform(parts, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def cell(word, bits: int) -> Column:
    return F.shiftrightunsigned(word, 64 - bits).cast("int")


def rarity(docs: DataFrame, bits: int, name: str) -> DataFrame:
    """The level of every cell, as a stored table of one row with an array of
    bytes (``levels``); three levels double the count.  The table's size is fixed by
    ``bits``, whatever the corpus.  Any levels give the same pairs, so words are
    parted at spaces alone here."""
    word = docs.select(F.explode(F.split("text", " ", -1)).alias("w")).select(cell(F.xxhash64("w"), bits).alias("c"))
    count = word.groupBy("c").agg(F.count("*").alias("n"))
    level = F.least(F.floor(F.log2(F.col("n") + 1.0) * 3), F.lit(126)).cast("int")
    # at most 2^bits small numbers, cell and level in one
    part = count.select((F.col("c") * 128 + level).alias("v")).groupBy(F.shiftright("v", 17).alias("part")).agg(F.collect_list("v").alias("v"))
    out = bytearray(1 << bits)
    for row in part.select("v").collect():
        for v in row["v"]:
            out[v >> 7] = v & 127
    # of an array one item is read at a time, and of bytes all
    row = pa.table({"levels": pa.array([np.frombuffer(out, np.int8)], pa.list_(pa.int8()))})
    return stored(docs.sparkSession.createDataFrame(row), f"{name}-levels")


def with_levels(df: DataFrame, levels: DataFrame) -> DataFrame:
    """``df`` with the table in a column ``levels``, read where it is used: the
    optimizer puts the subquery in the column's place, so neither the plan nor a
    row holds its bytes."""
    return df.withColumn("levels", levels.scalar())


def ordered_set(words, bits: int) -> Column:
    """The words as numbers, rarest first; needs the column ``levels``."""

    def number(w):
        own = F.get(F.col("levels"), cell(w, bits)).cast("long")
        # every cell has a level; where a number could be null, Spark would sort
        # and pass on objects instead of plain numbers
        return F.coalesce(F.shiftleft(own, 56).bitwiseOR(F.shiftrightunsigned(w, 8)), F.lit(0).cast("long"))

    return F.sort_array(F.transform(words, number))


def sketch(s) -> Column:
    """Parities of the words' counts in 64 cells.  Sets differ in at least as
    many words as their sketches do in bits."""
    return F.aggregate(s, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))))


def may_match(n, m, k, l, percent: int) -> Column:
    """Length filter, and the sketches' bound on the difference."""
    return ((percent * F.greatest(n, m) <= 100 * F.least(n, m))
            & ((100 + percent) * F.bit_count(k.bitwiseXOR(l)) <= (100 - percent) * (n + m)))


def place(doc, h, at) -> Column:
    """The order of lines: by id (nulls last), text, place."""
    return F.struct(doc.isNull().alias("last"), doc.alias("doc"), h.alias("h"), at.alias("at"))


def least_common(n, m, percent: int) -> Column:
    """The smallest intersection of similar sets of sizes n and m."""
    return F.floor(((n + m) * percent + 99 + percent) / F.lit(100 + percent))


def later_of(pairs: DataFrame, classes: DataFrame, docs: DataFrame, levels: DataFrame, p: Lines, name: str) -> DataFrame:
    """id of the later line of every pair (a, b) that is similar, verified on
    the whole sets."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(classes.join(asked, "id", "left_semi").select("id", "doc", "h", "at"), f"{name}-wanted")
    # a bit table of fixed size keeps most other documents out
    bit = F.pmod(F.xxhash64("doc", "h"), F.lit(_BITS))
    words = (wanted.select(bit.alias("b")).groupBy(F.floor(F.col("b") / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits")))
    every = wanted.sparkSession.range(_BITS // 64).select(F.col("id").cast("int").alias("w")).join(words, "w", "left")
    bits = stored(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                        lambda x: x["bits"]).alias("bits")), f"{name}-bits")
    near = F.getbit(F.element_at(bits.scalar(), (F.floor(bit / 64) + 1).cast("int")), (bit % 64).cast("int")) == 1
    w, line = wanted.alias("w"), lines_of(docs.where(near)).alias("l")
    same = (F.col("w.h") == F.col("l.h")) & (F.col("w.at") == F.col("l.at")) & F.col("w.doc").eqNullSafe(F.col("l.doc"))
    found = with_levels(line.join(w, same).select("w.id", "w.doc", "w.h", "w.at", "line"), levels)
    sets = stored(found.select("id", "doc", "h", "at", ordered_set(words_of(F.col("line")), p.cell_bits).alias("s"))
                  .dropDuplicates(["id"]), f"{name}-sets")
    one = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"), place(F.col("doc"), F.col("h"), F.col("at")).alias("pa"))
    two = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"), place(F.col("doc"), F.col("h"), F.col("at")).alias("pb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.hint("merge").join(one, "a").hint("merge").join(two, "b")
            .where(100 * both >= p.percent * (F.size("sa") + F.size("sb") - both))
            .select(F.when(F.col("pa") < F.col("pb"), F.col("b")).otherwise(F.col("a")).alias("id")).distinct())


def removed_lines(docs: DataFrame, p: Lines = Lines(), name: str = "lines") -> DataFrame:
    """doc, h, at of every line that an earlier line removes (``docs``: keyed)."""
    raw = lines_of(docs).select("doc", "h", "at", words_of(F.col("line")).alias("words"))
    levels = rarity(docs, p.cell_bits, name)
    n = F.size("s")
    prefix = n - F.floor((n * p.percent + 99) / F.lit(100)).cast("int") + 1
    sets = stored(with_levels(raw, levels).select("doc", "h", "at", ordered_set(F.col("words"), p.cell_bits).alias("s"))
                  .select("doc", "h", "at", F.xxhash64("s").alias("id"), n.alias("n"), sketch(F.col("s")).alias("k"),
                          F.slice("s", F.lit(1), prefix).alias("prefix")),
                  f"{name}-sets").where(F.col("n") >= (1 if p.short_copies else max(1, p.min_words)))  # before the table, the words would be split twice

    # one row per distinct set: its first line
    first = F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "h", "at", "n", "k", "prefix")).alias("f")
    classes = stored(sets.groupBy("id").agg(first, F.count("*").alias("lines")).select("id", "f.*", "lines"), f"{name}-classes")

    # below this size only an equal set is similar enough
    least = next(k for k in range(1, 10_000) if 100 * k >= p.percent * (k + 1))
    posts = classes.where(F.col("n") >= max(least, p.min_words)).select("id", "doc", "n", "k", F.posexplode("prefix").alias("pos", "w"))
    order = F.coalesce("doc", F.lit(2**63 - 1))
    lists = (posts.groupBy("w").agg(F.count("*").alias("c"), F.min_by("id", order).alias("rep"),
                                    F.min_by("n", order).alias("m"), F.min_by("k", order).alias("l"))
             .where("c > 1").drop("c"))
    # each line with the first one of its words' lists, where they may match
    tied = (F.col("id") != F.col("rep")) & may_match(F.col("n"), F.col("m"), F.col("k"), F.col("l"), p.percent)
    live = stored(posts.hint("merge").join(lists, "w").select("id", "n", "k", "pos", "w", F.when(tied, F.col("rep")).alias("rep")),
                  f"{name}-lists")
    pair = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    star = stored(live.where("rep is not null").select(F.col("id").alias("x"), F.col("rep").alias("y")).select(*pair).distinct(),
                  f"{name}-star")
    settled = stored(later_of(star, classes, docs, levels, p, name), f"{name}-settled")

    # lines not settled (open), with every line of the lists that may be similar;
    # a bit table of fixed size tells most lines that are open from the others
    hit = has_bit(bit_table(settled.select(F.col("id").alias("key")), 23, f"{name}-settled-bits"), F.col("id"), 23)
    post = live.select("id", "n", "k", "pos", "w")
    asked = post.where(hit).join(settled.withColumn("done", F.lit(True)), "id", "left")
    post = (post.where(~hit).withColumn("open", F.lit(True))
            .unionByName(asked.withColumn("open", F.col("done").isNull()).drop("done")))
    # both sides are the same rows, which are shuffled once
    x, y = (post.select(*(F.col(c).alias(f"{c}{s}") for c in ("id", "n", "k", "pos", "open")), "w") for s in "xy")
    # a shared word at these places leaves so many that can be common: itself,
    # those before it at most on the shorter side, and those after it
    room = F.least(F.col("nx") - F.col("posx"), F.col("ny") - F.col("posy"))
    more = stored(x.hint("merge").join(y, "w").where(
        (F.col("idx") < F.col("idy")) & (F.col("openx") | F.col("openy"))
        & may_match(F.col("nx"), F.col("ny"), F.col("kx"), F.col("ky"), p.percent)
        & (room + F.least("posx", "posy") >= least_common(F.col("nx"), F.col("ny"), p.percent)))
        .select(F.col("idx").alias("a"), F.col("idy").alias("b")).distinct().join(star, ["a", "b"], "left_anti"), f"{name}-pairs")
    late = settled.unionAll(later_of(more, classes, docs, levels, p, name)).distinct().withColumn("late", F.lit(True))

    fate = stored(classes.select("id", F.col("last").alias("l0"), F.col("doc").alias("d0"), F.col("h").alias("h0"), F.col("at").alias("a0"), "lines")
                  .join(late, "id", "left").where("late or lines > 1"), f"{name}-fate")
    own = place(F.col("doc"), F.col("h"), F.col("at"))
    head = F.struct(F.col("l0").alias("last"), F.col("d0").alias("doc"), F.col("h0").alias("h"), F.col("a0").alias("at"))
    return (sets.select("doc", "h", "at", "id").hint("merge").join(fate, "id")
            .where(F.coalesce("late", F.lit(False)) | (own > head)).select("doc", "h", "at"))


def deduplicated(docs: DataFrame, p: Lines = Lines(), name: str = "lines", removed: str = "__removed") -> DataFrame:
    """``docs`` with its kept text in place of ``text``, and ``removed``, the
    number of lines removed from it."""
    cols = list(docs.columns)
    gone = stored(removed_lines(keyed(docs), p, name).groupBy("doc", "h").agg(F.sort_array(F.collect_set("at")).alias("gone")), f"{name}-gone")
    # the row is one column beside those of this join, whatever its own are called
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("doc_id").cast("long").alias("own_doc"),
                    F.xxhash64("text").alias("own_h"), "text")
    # most texts lose nothing and stay where they are; a bit table of fixed size
    # tells which may
    key = F.xxhash64(F.coalesce("own_doc", F.lit(-1)), "own_h")
    bits = bit_table(gone.select(F.xxhash64(F.coalesce("doc", F.lit(-1)), "h").alias("key")), 23, f"{name}-gone-bits")
    hit = has_bit(bits, key, 23)
    joined = d.where(hit).join(gone, (F.col("own_h") == F.col("h")) & F.col("own_doc").eqNullSafe(F.col("doc")), "left")
    kept = F.array_join(F.filter(text_lines(F.col("text")), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept)

    def out(df: DataFrame, text: Column, n: Column) -> DataFrame:
        return df.select(*((text if c == "text" else F.col("row")[c]).alias(c) for c in cols), n.alias(removed))

    return out(joined, text, F.coalesce(F.size("gone"), F.lit(0))).unionByName(out(d.where(~hit), F.col("text"), F.lit(0)))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.when(F.col("__removed") > 0, F.col("__removed")).otherwise(0).cast("long").alias("n_removed"),
                    F.char_length("text").cast("long").alias("n_chars"), "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the kept text of every document; a document that loses
    its last words this way is a copy, and goes."""
    removed = fresh(docs, "__removed")
    d = deduplicated(docs, name="stage-lines", removed=removed).where(
        (F.col(removed) <= 0) | (F.btrim("text", F.lit(_SPACES)) != ""))
    return d.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
l AS (SELECT doc_id, ln - 1 AS ln, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS ws FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM d)),
k AS (SELECT doc_id, ln, list_sort(ws) AS ws FROM l WHERE len(ws) >= 5),
c AS (SELECT ws, row_number() OVER (ORDER BY min((doc_id, ln))) AS id, min((doc_id, ln)) AS head, len(ws) AS n FROM k GROUP BY ws),
w AS (SELECT id, n, head, unnest(ws) AS word FROM c WHERE n >= 9),
f AS (SELECT word, count(*) AS c FROM w GROUP BY word),
o AS (SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY c, word) AS pos FROM w JOIN f USING (word)),
p AS (SELECT * FROM o WHERE pos <= n - ceil(0.9 * n - 0.000001) + 1),
q AS (SELECT DISTINCT x.id AS a, y.id AS b FROM p x JOIN p y ON x.word = y.word AND x.id < y.id
  AND 90 * greatest(x.n, y.n) <= 100 * least(x.n, y.n)),
late AS (SELECT DISTINCT b AS id FROM (SELECT a, b, count(*) AS i FROM q JOIN w x ON x.id = a JOIN w y ON y.id = b AND y.word = x.word
  GROUP BY a, b) JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b WHERE 100 * i >= 90 * (ca.n + cb.n - i)),
g AS (SELECT doc_id, list(ln) AS gone FROM k JOIN c USING (ws) WHERE (doc_id, ln) > head OR id IN (SELECT id FROM late) GROUP BY doc_id),
t AS (SELECT documents.doc_id, gone, CASE WHEN gone IS NULL THEN text ELSE array_to_string(
  list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text
  FROM documents LEFT JOIN g ON g.doc_id = documents.doc_id)
SELECT doc_id, coalesce(len(gone), 0)::BIGINT AS n_removed, length(text)::BIGINT AS n_chars, text FROM t
"""
