"""Repair of the role structure of conversations, by a run-length DP.

Rows of a conversation are read in order as symbols: the role's initial and the
row's first fault (blank, duplicate of an earlier row, truncated).  The cheapest
edits are found that make the roles ``(system? (user assistant)+)?``: a row is
kept, given another role, or deleted (blank and duplicate ones must be), and
empty rows are inserted.  Four states say what may come next: nothing seen, a
system row, a user row, an assistant row.  A symbol is a min-plus matrix over
them (the insertions before the row included).  Equal consecutive symbols are
collapsed into runs; the cost that remains before a run is the power of its
matrix, put together from cached binary powers, applied to the cost behind it.
The choices are then unrolled from the front, one run at a time, always the
ASCII-least initial of a cheapest way (D, I, K, R), which gives the audit.

The rows are range partitioned by conversation and place, so a conversation that
holds most rows is read by many tasks; each turns its stretch into runs and
counts.  What comes together per conversation is its runs (the audit, which is
one value, has a character per row anyway).  The digest of the repaired text
needs its rows in order: they stream through a sorted partition behind their
conversation's runs, and no task holds a conversation's texts.

Defined results: a null role or text counts as one space; a null turn comes first
and is no turn in ``gaps``; a null conversation id is one conversation; rows of
one turn are ordered by role, then text; a role that begins with none of s, u, a can
only be changed or deleted; an empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

# ------------------------------------------------------------------ the edits
#: Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
#: Where an inserted or changed row leads, and its role.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

#: A symbol is one character: the initial's place in "suax" (x: any other), 4
#: more for truncated; 8 is a row that must go, whatever its role.
GONE = 8


def kept_state(state: int, symbol: int) -> int | None:
    """The state after the row is kept, if it may be."""
    to = (SYSTEM, USER, ASSISTANT, None)[symbol % 4] if symbol != GONE else None
    if to == SYSTEM:
        return SYSTEM if state == START else None
    return to if to is not None and TURN[state] == to else None


def product(a, b):
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def applied(a, v):
    return tuple(min(a[i][j] + v[j] for j in range(4)) for i in range(4))


def _inserts():
    """Cheapest insertions from state to state (none, one or two)."""
    m = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    for i in range(4):
        m[i][TURN[i]] = min(m[i][TURN[i]], INSERT)
        two = TURN[TURN[i]]
        m[i][two] = min(m[i][two], 2 * INSERT)
    return tuple(map(tuple, m))


INSERTS = _inserts()


def one_row(symbol: int):
    """Matrix of a row's own edits."""
    m = [[FAR] * 4 for _ in range(4)]
    extra = TRUNCATED if symbol != GONE and symbol >= 4 else 0
    for i in range(4):
        m[i][i] = DELETE
        if symbol != GONE:
            m[i][TURN[i]] = min(m[i][TURN[i]], REROLE + extra)
            kept = kept_state(i, symbol)
            if kept is not None:
                m[i][kept] = min(m[i][kept], KEEP + extra)
    return tuple(map(tuple, m))


OWN = [one_row(s) for s in range(GONE + 1)]
#: Per symbol: its matrix with the insertions before it, to the powers 1, 2, 4 ...
_POWERS = [[product(INSERTS, m)] for m in OWN]
#: The cost that remains behind the last row: nothing kept at all, or an
#: assistant row last, possibly inserted.
END = applied(INSERTS, (0, FAR, FAR, 0))


def power(symbol: int, k: int):
    """The symbol's matrix to the power 2^k."""
    own = _POWERS[symbol]
    while len(own) <= k:
        own.append(product(own[-1], own[-1]))
    return own[k]


def before_run(symbol: int, n: int, v):
    """The cost that remains before ``n`` rows of a symbol, if ``v`` remains behind."""
    k = 0
    while n >> k:
        if n >> k & 1:
            v = applied(power(symbol, k), v)
        k += 1
    return v


def repaired(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of a conversation given as runs of (symbol, rows)."""
    behind = [END]
    for symbol, n in reversed(runs):
        behind.append(before_run(symbol, n, behind[-1]))
    behind.reverse()  # behind[r]: before run r
    state, audit = START, []
    for r, (symbol, n) in enumerate(runs):
        step, own = power(symbol, 0), OWN[symbol]
        left = [behind[r + 1]]  # left[k]: before the last k rows of the run
        for _ in range(n - 1):
            left.append(applied(step, left[-1]))
        for k in range(n - 1, -1, -1):
            v = left[k]
            due = min(step[state][j] + v[j] for j in range(4))
            while True:  # D, I, K, R: the first that keeps to what is due
                if DELETE + v[state] == due:
                    audit.append("D")
                    break
                to = TURN[state]
                if INSERT + min(step[to][j] + v[j] for j in range(4)) == due:
                    audit.append("I")
                    state, due = to, due - INSERT
                    continue
                kept = kept_state(state, symbol)
                extra = TRUNCATED if symbol >= 4 else 0
                if kept is not None and KEEP + extra + v[kept] == due:
                    audit.append("K")
                    state = kept
                else:
                    audit.append("R")
                    state = to
                break
    while state not in (START, ASSISTANT):
        audit.append("I")
        state = TURN[state]
    return behind[0][START], "".join(audit)


# ------------------------------------------------------------------- the rows
#: What damages a row, by crc32 modulo 20.
DROP, BLANK, STRIP, REPEAT, TO_USER = range(5)


def damaged(conversations: DataFrame) -> DataFrame:
    """cid (the conversation id as text, '=' before it; null: empty), turn,
    role, text of the rows after damage, and ``row``, which tells equal rows apart."""
    cid, turn = F.col("conv_id").cast("string"), F.col("turn").cast("long")
    blank = F.lit(" ")
    key = F.concat(F.coalesce(cid, blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    d = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("="), cid), F.lit("")).alias("cid"), turn.alias("turn"), d.alias("d"),
        F.when(d == TO_USER, "user").otherwise(role).alias("role"),
        F.when(d == BLANK, "").when(d == STRIP, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.monotonically_increasing_id().alias("row")).where(F.col("d") != DROP)
    twice = F.when(F.col("d") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(twice)).drop("d")


def plain(conversations: DataFrame) -> DataFrame:
    """The same columns without damage."""
    blank = F.lit(" ")
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("cid"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.monotonically_increasing_id().alias("row"), F.lit(0).alias("copy"))


def placed(rows: DataFrame, name: str) -> DataFrame:
    """The rows with ``pos``, a number that rises with their place, and their
    own symbol's parts: initial, blank, truncated.  Rows that are equal in all
    else are parted by ``row``, so that any range can be split."""
    order = ["cid", F.col("turn").asc_nulls_first(), "role", "text", "row", "copy"]
    parts = max(8, rows.sparkSession.sparkContext.defaultParallelism)
    last = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), -1, 1)
    return stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .select("cid", F.monotonically_increasing_id().alias("pos"), "turn", "role", "text",
                          F.substring("role", 1, 1).alias("initial"), (last == "").alias("blank"),
                          (~last.isin(".", "!", "?")).alias("truncated"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")),
                  f"{name}-rows")


def symbols(rows: DataFrame, name: str) -> DataFrame:
    """cid, pos, turn, initial, symbol and whether the row is blank or duplicate."""
    narrow = rows.select("cid", "pos", "turn", "role", "digest", "initial", "blank", "truncated")
    # the first of equal rows: one aggregation with a partial stage, joined back by place
    firsts = narrow.groupBy("cid", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    known = narrow.drop("role", "digest").join(firsts, "pos", "left").withColumn("duplicate", ~F.col("blank") & F.col("first").isNull()).drop("first")
    own = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    symbol = F.when(F.col("blank") | F.col("duplicate"), GONE).otherwise(own + F.when(F.col("truncated"), 4).otherwise(0))
    return stored(known.withColumn("symbol", symbol), f"{name}-symbols")


_CHUNK = ("cid string, pos long, runs binary, first string, last string, illegal long, blank long, duplicate long, truncated long, "
          "low long, high long, turns long, after long")


def chunks(known: DataFrame) -> DataFrame:
    """One row per conversation and stretch of it: its runs (symbol and
    number of rows, 9 bytes each), counts, first and last initial, and lowest,
    highest, number and last of its turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("cid", "pos", "turn", "initial", "symbol", "blank", "duplicate", "truncated")))
            out = []
            for cid, own in groupby(rows, key=lambda r: r[0]):
                own = list(own)
                runs = b"".join(bytes([s]) + len(list(g)).to_bytes(8, "little") for s, g in groupby(r[4] for r in own))
                turns = [r[2] for r in own if r[2] is not None]
                out.append((cid, own[0][1], runs, own[0][3], own[-1][3],
                            sum(x[3] + y[3] not in LEGAL for x, y in zip(own, own[1:])),
                            sum(r[5] for r in own), sum(r[6] for r in own), sum(r[7] and not r[5] and not r[6] for r in own),
                            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), own[-1][1]))
            yield pa.RecordBatch.from_pylist([dict(zip(_CHUNK_NAMES, r)) for r in out], schema=_CHUNK_SCHEMA)

    ordered = known.repartitionByRange(max(8, known.sparkSession.sparkContext.defaultParallelism), "pos").sortWithinPartitions("pos")
    return ordered.mapInArrow(run, _CHUNK)


#: The pairs of initials that may follow each other.
LEGAL = {"su", "ua", "au"}
_CHUNK_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]
_CHUNK_SCHEMA = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in _CHUNK.split(", ")])


class _Conversation:
    """What is known of a conversation while its rows stream by."""

    def __init__(self, cid: str):
        self.cid, self.runs, self.last = cid, [], None
        self.counts = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = None
        self.turns, self.audit, self.cost = 0, None, 0

    def add(self, c: dict) -> None:
        raw = c["runs"]
        for i in range(0, len(raw), 9):
            symbol, n = raw[i], int.from_bytes(raw[i + 1 : i + 9], "little")
            if self.runs and self.runs[-1][0] == symbol:
                self.runs[-1] = (symbol, self.runs[-1][1] + n)
            else:
                self.runs.append((symbol, n))
        for k in ("blank", "duplicate", "truncated", "illegal"):
            self.counts[k] += c[k]
        if self.last is not None:
            self.counts["illegal"] += self.last + c["first"] not in LEGAL
        self.last = c["last"]
        if c["low"] is not None:
            self.turns += c["turns"] - (self.high == c["low"])  # a turn that goes on here
            self.low = c["low"] if self.low is None else self.low
            self.high = c["high"]

    def solve(self) -> None:
        self.cost, self.audit = repaired(self.runs)
        if self.low is not None:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        self.at, self.state, self.digest, self.any = 0, START, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.digest.update(((f"\n{role}:{text}") if self.any else f"{role}:{text}").encode())
        self.any = True

    def insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, self.at = TURN[self.state], self.at + 1
            self._put(ROLE[self.state], "")

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "R":
            self.state = TURN[self.state]
            self._put(ROLE[self.state], text)
        elif edit == "K":
            self.state = INITIALS[role[0]]
            self._put(role, text)

    def result(self) -> dict:
        self.insert()
        return {"cid": self.cid, **self.counts, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.digest.hexdigest()}


_RESULT = [("cid", pa.string()), *((k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
           ("audit", pa.string()), ("repaired_sha256", pa.string())]


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of many conversations: of each its mark, its chunks, its texts."""
    now: _Conversation | None = None
    for b in batches:
        out = []
        for r in b.to_pylist():
            if now is None or r["cid"] != now.cid:
                if now is not None:
                    if now.audit is None:
                        now.solve()
                    out.append(now.result())
                now = _Conversation(r["cid"])
            if r["kind"] == 1:
                now.add(r)
            elif r["kind"] == 2:
                if now.audit is None:
                    now.solve()
                now.row(r["role"], r["text"])
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_RESULT))
    if now is not None:
        if now.audit is None:
            now.solve()
        yield pa.RecordBatch.from_pylist([now.result()], schema=pa.schema(_RESULT))


def repaired_conversations(conversations: DataFrame, rows: DataFrame, name: str = "conversations") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conversation of ``conversations``; ``rows``: its rows
    as :func:`damaged` or :func:`plain` gives them."""
    kind = conversations.schema["conv_id"].dataType
    at = placed(rows, name)
    parts = stored(chunks(symbols(at, name)), f"{name}-chunks")
    marks = conversations.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("cid")).distinct()
    stream = (marks.withColumns({"kind": F.lit(0), "pos": F.lit(0).cast("long")})
              .unionByName(parts.withColumn("kind", F.lit(1)), allowMissingColumns=True)
              .unionByName(at.select("cid", F.lit(2).alias("kind"), "pos", "role", "text"), allowMissingColumns=True))
    out = (stream.repartition("cid").sortWithinPartitions("cid", "kind", "pos")
           .mapInArrow(_repairs, "cid string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                 "audit string, repaired_sha256 string"))
    conv_id = F.when(F.col("cid") != "", F.expr("substring(cid, 2)")).cast(kind)
    return out.select(conv_id.alias("conv_id"), *[c for c, _ in _RESULT[1:]])


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repaired_conversations(rows, damaged(rows))


# The cheapest (cost, audit) pairs per state, from the last row back, then the
# audit's edits applied from the front.
SQL = r"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM (SELECT unnest(range(256)) AS i))),
r AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS q, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS rn,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
c AS (SELECT r.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(key)), lambda i: ascii(substr(key, i + 1, 1))::BIGINT)),
  lambda a, b: xor(a // 256, tab[xor(a % 256, b) + 1])), 4294967295) % 20 AS d FROM r, tab),
m AS (SELECT q, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, rn,
  unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE d <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY turn NULLS FIRST, role, text, rn, copy) AS i,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS z FROM m),
f AS (SELECT *, substr(role, 1, 1) AS ini, z = '' AS blank,
  z <> '' AND row_number() OVER (PARTITION BY q, role, text ORDER BY i) > 1 AS dup FROM n),
g AS (SELECT *, NOT blank AND NOT dup AND z NOT IN ('.', '!', '?') AS trunc, lag(ini) OVER (PARTITION BY q ORDER BY i) || ini AS pair FROM f),
t AS (SELECT q, (max(turn) - min(turn) + 1 - count(DISTINCT turn))::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
  count(*) FILTER (trunc) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM g GROUP BY q),
o AS (SELECT DISTINCT q, conv_id FROM r),
s AS (
  SELECT o.q, coalesce(n, 0) + 1 AS i, {'c': 0, 'a': ''} AS b0, {'c': 4, 'a': 'II'} AS b1, {'c': 2, 'a': 'I'} AS b2, {'c': 0, 'a': ''} AS b3
  FROM o LEFT JOIN t USING (q)
  UNION ALL
  SELECT q, i, least(o0, {'c': o2.c + 2, 'a': 'I' || o2.a}, {'c': o3.c + 4, 'a': 'II' || o3.a}),
    least(o1, {'c': o2.c + 2, 'a': 'I' || o2.a}, {'c': o3.c + 4, 'a': 'II' || o3.a}),
    least(o2, {'c': o3.c + 2, 'a': 'I' || o3.a}), least(o3, {'c': o2.c + 2, 'a': 'I' || o2.a})
  FROM (
    SELECT q, i, least({'c': b0.c + 3, 'a': 'D' || b0.a}, {'c': b2.c + IF(must, 99999999, 2 + x), 'a': 'R' || b2.a},
        {'c': IF(ini = 's', b1.c, b2.c) + IF(must OR ini NOT IN ('s', 'u'), 99999999, x), 'a': 'K' || IF(ini = 's', b1.a, b2.a)}) AS o0,
      least({'c': b1.c + 3, 'a': 'D' || b1.a}, {'c': b2.c + IF(must, 99999999, 2 + x), 'a': 'R' || b2.a},
        {'c': b2.c + IF(must OR ini <> 'u', 99999999, x), 'a': 'K' || b2.a}) AS o1,
      least({'c': b2.c + 3, 'a': 'D' || b2.a}, {'c': b3.c + IF(must, 99999999, 2 + x), 'a': 'R' || b3.a},
        {'c': b3.c + IF(must OR ini <> 'a', 99999999, x), 'a': 'K' || b3.a}) AS o2,
      least({'c': b3.c + 3, 'a': 'D' || b3.a}, {'c': b2.c + IF(must, 99999999, 2 + x), 'a': 'R' || b2.a},
        {'c': b2.c + IF(must OR ini <> 'u', 99999999, x), 'a': 'K' || b2.a}) AS o3
    FROM (SELECT s.q, g.i, b0, b1, b2, b3, ini, blank OR dup AS must, IF(trunc, 1, 0) AS x FROM s JOIN g ON g.q = s.q AND g.i = s.i - 1))),
a AS (SELECT q, b0.c::BIGINT AS cost, b0.a AS audit FROM s WHERE i = 1),
u AS (
  SELECT q, 1 AS k, 1::BIGINT AS i, 0 AS st, []::VARCHAR[] AS lines FROM a
  UNION ALL
  SELECT u.q, k + 1, u.i + IF(e = 'I', 0, 1), CASE e WHEN 'D' THEN st WHEN 'K' THEN CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE nx END,
    CASE e WHEN 'D' THEN lines WHEN 'I' THEN list_append(lines, IF(nx = 2, 'user', 'assistant') || ':')
      WHEN 'K' THEN list_append(lines, role || ':' || text) ELSE list_append(lines, IF(nx = 2, 'user', 'assistant') || ':' || text) END
  FROM (SELECT u.*, substr(audit, k, 1) AS e, IF(st = 2, 3, 2) AS nx FROM u JOIN a ON a.q = u.q WHERE k <= length(audit)) u
  LEFT JOIN g ON g.q = u.q AND g.i = u.i)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, cost, audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM o LEFT JOIN t USING (q) JOIN a USING (q) JOIN u ON u.q = o.q AND u.k = length(audit) + 1
"""
