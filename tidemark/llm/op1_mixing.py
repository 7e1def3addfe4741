"""Mixing to target weights with soft domain membership.

A softmax classifier, fitted on a bounded sample of labelled documents, gives
each document a posterior over the domains.  Distributed projected-gradient
least squares then finds nonnegative document rates (expected numbers of uses)
whose expected domain token totals match the targets.

The rate of a document is a function of its posterior and of the history of
domain residuals alone: r <- clip(r - sum_d p_d (S_d - W_d) / N_d).  A step
therefore needs one pass over (tokens, posterior) that returns one sum per
domain; no per-document state is kept between steps.  With N_d the domain's
total at rate 1, the step's matrix has the largest eigenvalue 1, so a unit step
never diverges.  Steps go on until every domain meets its target within the
tolerance.  Where they cannot (a lower rate limit in the way, or posteriors that
do not tell the domains apart) they end as soon as they gain nothing more, with
a warning that names each domain's residual; the rate column's metadata has it too.

Defined results: a null or blank text has no tokens, the sample's mean
posterior and its rate like any other; without labelled rows every posterior is
uniform; a domain without tokens takes no part; repeated rows and null ids each
keep their row; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import crc32_of, small_batches, stored, table

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Byte pairs are counted in so many cells, by a multiplicative hash.
CELLS = 512


@dataclass(frozen=True)
class Mix:
    """Targets and limits.  ``targets``: the wanted share of tokens of each
    domain; ``low`` stands for documents labelled as of low quality, the others
    for the language of a labelled document."""

    targets: dict = field(default_factory=lambda: {"en": 0.52, "de": 0.16, "fr": 0.16, "es": 0.13, "low": 0.03})
    #: The classifier's sample: so many labelled documents at most, the first
    #: by the crc32 of their id.
    sample_rows: int = 4000
    #: Tokens wanted in all, as a multiple of the tokens there are; None: just
    #: enough that no domain has to lose any.
    budget: float | None = 1.0
    min_rate: float = 0.0
    max_rate: float = float("inf")
    #: Only a guard: the steps end before it, at the tolerance or where they
    #: gain nothing; the residual is reported in any case.
    steps: int = 1000
    tolerance: float = 1e-4  # of the budget, in every domain
    seed: int = 11


def text_features(text: str | None) -> tuple[int, np.ndarray]:
    """(words, square roots of the shares of byte pairs by hashed cell)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return 0, np.zeros(CELLS, np.float32)
    space = _SPACE[raw]
    words = int(np.count_nonzero(~space[1:] & space[:-1])) + (not space[0])
    pair = (raw[:-1].astype(np.uint32) << 8) | raw[1:]
    cell = (pair * np.uint32(2654435761)) >> np.uint32(23)
    count = np.bincount(cell, minlength=CELLS).astype(np.float32)
    return words, np.sqrt(count / max(1, len(pair)))


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, steps: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Weights (features + 1 by classes) by full-batch gradient descent with
    momentum; the same rows give the same weights."""
    x = np.column_stack([x, np.ones(len(x))])
    want = np.eye(classes)[y]
    w = np.zeros((x.shape[1], classes))
    v = np.zeros_like(w)
    rate = 4.0 / max(1e-9, (x**2).sum(1).mean())
    for _ in range(steps):
        g = x.T @ (softmax(x @ w) - want) / len(x) + ridge * w
        v = 0.9 * v - rate * g
        w += v
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, labels: DataFrame, domains: list[str], sample_rows: int) -> np.ndarray | None:
    """Classifier weights from at most ``sample_rows`` labelled documents."""
    chosen = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
              .agg(F.max("quality").alias("__quality")).orderBy(crc32_of(F.col("__id")), "__id").limit(sample_rows))
    domain = F.when((F.col("__quality") == 0) & F.lit("low" in domains), F.lit("low")).otherwise(F.col("lang"))

    # the chosen rows are bounded by the parameter
    rows = (docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
            .where((F.col("__quality") != 0) | F.lit("low" in domains))
            .select("doc_id", domain.alias("domain"), "text").where(F.col("domain").isin(domains)))

    def feats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "domain": b["domain"],
                                "x": [text_features(t)[1].tobytes() for t in b["text"]]})

    small_batches(docs.sparkSession)
    # a repeated document counts once, so the rows stay within the bound
    got = (rows.mapInPandas(feats, "doc_id long, domain string, x binary")
           .groupBy("doc_id").agg(F.min(F.struct("domain", "x")).alias("r")).collect())
    if not got:
        return None
    got.sort(key=lambda r: r["doc_id"])
    x = np.vstack([np.frombuffer(r["r"]["x"], np.float32) for r in got]).astype(float)
    return fit_softmax(x, np.array([domains.index(r["r"]["domain"]) for r in got]), len(domains))


def with_posteriors(docs: DataFrame, weights: np.ndarray | None, n_domains: int, text_col: str = "text",
                    rate: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``docs`` with a struct ``__mix`` of n_tokens and the posterior, and with
    ``rate`` (of the posteriors of some rows) their rate.  One function, as each
    that stands in a plan holds a worker of its own."""

    @pandas_udf("n_tokens long, posterior array<double>" + (", rate double" if rate else ""))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [text_features(t) for t in texts]
            if weights is None or not found:
                p = np.full((len(found), n_domains), 1 / n_domains)
            else:
                x = np.vstack([f[1] for f in found])
                p = np.round(softmax(np.column_stack([x, np.ones(len(x))]) @ weights), 6)
                p /= p.sum(1, keepdims=True)
            out = pd.DataFrame({"n_tokens": [f[0] for f in found], "posterior": list(p)})
            yield out.assign(rate=rate(p)) if rate else out

    small_batches(docs.sparkSession)
    return docs.withColumn("__mix", run.asNondeterministic()(F.col(text_col)))


def replayed(p: np.ndarray, history: list[np.ndarray], lo: float, hi: float) -> np.ndarray:
    """The rates after the steps in ``history`` (scaled residuals)."""
    r = np.clip(np.ones(len(p)), lo, hi)
    for u in history:
        r = np.clip(r - p @ u, lo, hi)
    return r


def totals(members: DataFrame, history: list[np.ndarray], k: int, lo: float, hi: float) -> np.ndarray:
    """Expected token totals by domain at the rates after ``history``."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = np.zeros(k)
        for b in batches:
            if len(b):
                p = np.vstack(b["posterior"].to_numpy())
                s += (b["n_tokens"].to_numpy() * replayed(p, history, lo, hi)) @ p
        yield pd.DataFrame({"d": range(k), "s": s})

    got = members.mapInPandas(part, "d int, s double").groupBy("d").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(k)
    for row in got:
        out[row["d"]] = row["s"]
    return out


#: The steps have come to an end if so many of them make the least squares
#: smaller by less than this share.
GAIN_STEPS, GAIN = 20, 0.05


def residuals(reached: np.ndarray, wanted: np.ndarray, mix: Mix) -> dict[str, float]:
    """What each domain got too much, as a share of the tokens wanted in all;
    a warning where that is beyond the tolerance."""
    total = float(wanted.sum())
    out = {d: float(r) / total if total else 0.0 for d, r in zip(mix.targets, reached - wanted)}
    if any(abs(r) > mix.tolerance for r in out.values()):
        warnings.warn(f"mixing misses its targets; residuals as shares of the budget: {out}", stacklevel=2)
    return out


def solve(members: DataFrame, mix: Mix) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(history of scaled residuals, totals reached, totals wanted)."""
    share = np.array(list(mix.targets.values()), float)
    k = len(share)
    lo, hi = mix.min_rate, mix.max_rate
    have = totals(members, [], k, 1.0, 1.0)
    live = have > 0
    share = np.where(live, share, 0.0)
    if not share.sum():
        return [], have, have
    share /= share.sum()
    wanted = share * (have.sum() * mix.budget if mix.budget is not None
                      else (have[share > 0] / share[share > 0]).max())
    history: list[np.ndarray] = []
    reached = have if lo <= 1 <= hi else totals(members, history, k, lo, hi)
    left = []  # what the descent makes smaller, at each step
    for _ in range(mix.steps):
        if np.abs(reached - wanted).max() <= mix.tolerance * wanted.sum():
            break
        left.append(((reached - wanted)[live] ** 2 / have[live]).sum())
        if len(left) > GAIN_STEPS and left[-1] > (1 - GAIN) * left[-1 - GAIN_STEPS]:
            break
        history.append(np.where(live, (reached - wanted) / np.where(live, have, 1.0), 0.0))
        reached = totals(members, history, k, lo, hi)
    return history, reached, wanted


def final_rates(p: np.ndarray, history: list[np.ndarray], mix: Mix) -> np.ndarray:
    return np.round(replayed(p, history, mix.min_rate, mix.max_rate), 6)


def rates(members: DataFrame, history: list[np.ndarray], mix: Mix) -> DataFrame:
    """``members`` with its rate and its whole number of uses."""

    @pandas_udf("double")
    def rate(posteriors: pd.Series) -> pd.Series:
        if not len(posteriors):
            return pd.Series([], dtype=float)
        return pd.Series(final_rates(np.vstack(posteriors.to_numpy()), history, mix))

    return with_copies(members.withColumn("rate", rate.asNondeterministic()("posterior")), mix)


def with_copies(out: DataFrame, mix: Mix) -> DataFrame:
    """The whole number of uses: the rate rounded up or down by chance, where
    chance is a hash of the row's id and text."""
    chance = F.pmod(F.xxhash64("doc_id", "digest", F.lit(mix.seed)), F.lit(1_000_003)) / 1_000_003
    return out.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("int"))


def mixed(docs: DataFrame, labels: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document: doc_id, n_tokens, domain (the likeliest),
    posterior, rate (its metadata: the residual of each domain), copies."""
    domains = list(mix.targets)
    weights = train(docs, labels, domains, mix.sample_rows)
    m = with_posteriors(docs.select("doc_id", "text"), weights, len(domains))
    members = stored(m.select("doc_id", F.xxhash64("text").alias("digest"), "__mix.n_tokens", "__mix.posterior"), "posteriors")
    history, reached, wanted = solve(members, mix)
    missed = residuals(reached, wanted, mix)
    names = F.array(*map(F.lit, domains))
    best = F.element_at(names, F.array_position("posterior", F.array_max("posterior")).cast("int"))
    rate = F.col("rate").alias("rate", metadata={"residuals": missed})
    return rates(members, history, mix).select("doc_id", "n_tokens", best.alias("domain"), "posterior", rate, "copies")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The pipeline's mix: languages only (quality has been dealt with), a budget
#: under which no language loses text, and at least one use of each document.
STAGE_MIX = Mix(targets={"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}, budget=None, min_rate=1.0)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as its rate says, once at least;
    the additional uses repeat its row."""
    mix, domains, cols = STAGE_MIX, list(STAGE_MIX.targets), list(docs.columns)
    weights = train(docs, table(spark, sf_dir, "labels"), domains, mix.sample_rows)
    # doc_id and the text's digest name a row's posterior, so texts are not
    # shuffled: rates are computed again beside the text
    # the row is one column beside those of this stage, whatever its own are called
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"))
    scored = with_posteriors(whole, weights, len(domains))
    members = stored(scored.select("doc_id", F.xxhash64("text").alias("digest"), "__mix.n_tokens", "__mix.posterior"),
                     "posteriors")
    history, reached, wanted = solve(members, mix)
    residuals(reached, wanted, mix)
    again = with_posteriors(whole, weights, len(domains), rate=lambda p: final_rates(p, history, mix))
    used = with_copies(again.select("*", F.xxhash64("text").alias("digest"), "__mix.rate"), mix)
    return used.withColumn("use", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
