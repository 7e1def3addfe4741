"""Quality scores from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  Its features are its own shape
(symbols, shouting, separators, repeats, punctuation, length) and those of the
lines before and after it; the chain adds transitions between neighbouring
labels.  Forward-backward gives each line's marginal probability of being good;
their mean, weighted by the lines' lengths, is mapped to the document's score by
a logistic curve.

The model is fitted on a bounded sample of labelled documents outside the
held-out fold; a document's label stands for all its lines.

Defined results: a null, empty or blank text has no lines and scores what the
training documents' share of label 1 says; labels that are null take no part;
of several labels of a document the smallest holds; without labels of both
kinds every text scores the prior; repeated rows and null ids are scored row by
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import WORD_RE, crc32_of, table

#: Labelled documents the model is fitted on, at most: the first by crc32 of
#: the id, half of them of each label.
SAMPLE_DOCS = 2000
#: A training document adds up to so many lines (scoring reads every line).
TRAIN_LINES = 64

_SYMBOL_WORD = re.compile(r"[^\x20\x09-\x0D]*[#*$%&<>^~{}\\][^\x20\x09-\x0D]*")
_SHOUT = re.compile(r"[!?]{2,}")
_UPPER = re.compile(r"[A-Z]")
_LOWER = re.compile(r"[a-z]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[.,;:!?…]")
_ENDS = tuple(".!?…:;\"'”»)")


def line_shape(line: str, words: list[str]) -> tuple[float, ...]:
    """The numbers a line is judged by, each about 0 to 1."""
    n = len(words)
    ascii_letters = len(_UPPER.findall(line)) + len(_LOWER.findall(line)) or 1
    return (
        len(_SYMBOL_WORD.findall(line)) / n if not line.isalnum() else 0.0,
        min(1.0, len(_SHOUT.findall(line)) / n) if "!" in line or "?" in line else 0.0,
        len(_UPPER.findall(line)) / ascii_letters,
        (line.count("|") + line.count("»") + line.count("•")) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(words)) / n,
        len(_MARK.findall(line)) / n if n < 12 else 2 * min(0.5, len(_MARK.findall(line)) / n),
        float(n >= 8 and not _MARK.search(line)),
        float(line.rstrip("\x20\t\n\v\f\r").endswith(_ENDS)),
        len(_DIGIT.findall(line)) / max(1, len(line)),
        min(1.0, n / 100),
        float(n < 4),
    )


SHAPES = 12


def doc_lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(one row of features per line with a word, word characters of each).
    A row: its shape, the shapes of its neighbours, an edge mark, a constant."""
    shapes, chars = [], []
    for line in (text or "").split("\n"):
        words = WORD_RE.findall(line)
        if words:
            shapes.append(line_shape(line, words))
            chars.append(sum(map(len, words)))
    if not shapes:
        return np.zeros((0, 3 * SHAPES + 2), np.float32), np.zeros(0)
    s = np.array(shapes, np.float32)
    none = np.zeros((1, SHAPES), np.float32)
    edge = np.zeros((len(s), 1), np.float32)
    edge[0] = edge[-1] = 1
    return np.hstack([s, np.vstack([none, s[:-1]]), np.vstack([s[1:], none]), edge,
                      np.ones((len(s), 1), np.float32)]), np.array(chars, float)


@dataclass
class Crf:
    """Two labels (0 bad, 1 good).  ``emit``: weights of label 1 against 0;
    ``step``: 2 x 2 transition scores; ``curve``: slope and intercept of the
    logistic map from the mean marginal; ``prior``: the score of no lines."""

    emit: np.ndarray
    step: np.ndarray
    curve: tuple[float, float]
    prior: float

    def score(self, texts) -> np.ndarray:
        parts = [doc_lines(t) for t in texts]
        out = np.full(len(parts), self.prior)
        some = [i for i, p in enumerate(parts) if len(p[0])]
        if some:
            good = marginals([parts[i][0] @ self.emit for i in some], self.step)
            mean = np.array([(g * parts[i][1]).sum() / parts[i][1].sum() for g, i in zip(good, some)])
            out[some] = 1 / (1 + np.exp(-(self.curve[0] * (mean - 0.5) + self.curve[1])))
        return out


def padded(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in scores])
    z = np.zeros((len(scores), n.max()))
    for i, s in enumerate(scores):
        z[i, : len(s)] = s
    return z, n


def forward_backward(z: np.ndarray, n: np.ndarray, step: np.ndarray):
    """Log messages of chains in rows: unary score ``z`` for label 1 (0 for
    label 0), ``n`` the lengths.  Returns (alpha, beta, log partition)."""
    d, t = z.shape
    u = np.stack([np.zeros_like(z), z], 2)
    alpha, beta = np.zeros((d, t, 2)), np.zeros((d, t, 2))
    alpha[:, 0] = u[:, 0]
    for i in range(1, t):
        a = alpha[:, i - 1, :, None] + step
        alpha[:, i] = np.logaddexp(a[:, 0], a[:, 1]) + u[:, i]
    for i in range(t - 2, -1, -1):
        b = step + (u[:, i + 1] + beta[:, i + 1])[:, None, :]
        new = np.logaddexp(b[:, :, 0], b[:, :, 1])
        beta[:, i] = np.where((i + 1 < n)[:, None], new, 0.0)
    last = alpha[np.arange(d), n - 1]
    return alpha, beta, np.logaddexp(last[:, 0], last[:, 1])


def marginals(scores: list[np.ndarray], step: np.ndarray, cells: int = 200_000) -> list[np.ndarray]:
    """P(good) of each line of each chain; chains of like length together, so
    that padding and memory stay bounded."""
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    out: list = [None] * len(scores)
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and len(scores[order[end]]) * (end + 1 - at) <= cells:
            end += 1
        part = order[at:end]
        z, n = padded([scores[i] for i in part])
        alpha, beta, log_z = forward_backward(z, n, step)
        good = np.exp(np.minimum(0.0, alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None]))
        for row, i in enumerate(part):
            out[i] = good[row, : n[row]]
        at = end
    return out


def fit(xs: list[np.ndarray], ys: np.ndarray, chars: list[np.ndarray], steps: int = 150, ridge: float = 1e-3) -> Crf:
    """Conditional likelihood by Adam on the whole sample: the gradient is
    observed minus expected features and transitions."""
    k = xs[0].shape[1]
    emit, step = np.zeros(k), np.zeros((2, 2))
    n = np.array([len(x) for x in xs])
    total = n.sum()
    order = np.argsort(n, kind="stable")
    groups = [g for g in np.array_split(order, max(1, len(order) // 200)) if len(g)]
    packed = []
    for g in groups:
        x = np.zeros((len(g), n[g].max(), k), np.float32)
        for row, i in enumerate(g):
            x[row, : n[i]] = xs[i]
        mask = np.arange(x.shape[1])[None] < n[g][:, None]
        packed.append((x, n[g], mask, ys[g].astype(float)))
    moment = [np.zeros(k + 4), np.zeros(k + 4)]
    for it in range(1, steps + 1):
        g_emit, g_step = np.zeros(k), np.zeros((2, 2))
        for x, m, mask, y in packed:
            z = np.where(mask, x @ emit, 0.0)
            alpha, beta, log_z = forward_backward(z, m, step)
            good = np.exp(np.minimum(0.0, alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None])) * mask
            g_emit += np.einsum("dt,dtk->k", y[:, None] * mask - good, x)
            if x.shape[1] > 1:
                u = np.stack([np.zeros_like(z), z], 2)
                pair = alpha[:, :-1, :, None] + step + (u + beta)[:, 1:, None, :] - log_z[:, None, None, None]
                pair = np.exp(np.minimum(0.0, pair)) * mask[:, 1:, None, None]
                links = (m - 1).astype(float)
                g_step += np.array([[((1 - y) * links).sum(), 0.0], [0.0, (y * links).sum()]]) - pair.sum((0, 1))
        grad = np.concatenate([g_emit, g_step.ravel()]) / total - ridge * np.concatenate([emit, step.ravel()])
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.99 * moment[1] + 0.01 * grad**2
        move = 0.15 * (moment[0] / (1 - 0.9**it)) / (np.sqrt(moment[1] / (1 - 0.99**it)) + 1e-9)
        emit, step = emit + move[:k], step + move[k:].reshape(2, 2)
    good = marginals([x @ emit for x in xs], step)
    mean = np.array([(g * c).sum() / c.sum() for g, c in zip(good, chars)])
    return Crf(emit, step, logistic(mean - 0.5, ys), 0.5)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method, labels softened at the ends."""
    want = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w, design = np.array([4.0, 0.0]), np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        grad = design.T @ (p - want) / len(x) + ridge * w
        hess = (design * (p * (1 - p))[:, None]).T @ design / len(x) + ridge * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def held_out(doc_id) -> F.Column:
    return F.pmod(crc32_of(doc_id), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Crf:
    """The model, from labelled documents outside the held-out fold only."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("__q")))
    prior = known.agg(F.avg("__q").alias("p")).first()["p"]
    order = [crc32_of(F.col("__id")), F.col("__id")]
    chosen = None
    for q in (0, 1):  # bounded by the parameter
        part = known.where(F.col("__q") == q).orderBy(*order).limit(sample_docs // 2)
        chosen = part if chosen is None else chosen.unionAll(part)

    def feats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [doc_lines(t) for t in b["text"]]
            # one window of lines of a long document, at a place set by its id
            at = [int(i) % max(1, len(p[1]) - TRAIN_LINES + 1) for i, p in zip(b["doc_id"], parts)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "q": b["__q"],
                                "x": [p[0][a : a + TRAIN_LINES].tobytes() for a, p in zip(at, parts)],
                                "c": [p[1][a : a + TRAIN_LINES].tobytes() for a, p in zip(at, parts)]})

    got = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
           .select("doc_id", "text", "__q").mapInPandas(feats, "doc_id long, q int, x binary, c binary")
           .groupBy("doc_id").agg(F.min(F.struct("q", "x", "c")).alias("r")).collect())
    got = sorted(((r["doc_id"], r["r"]) for r in got if len(r["r"]["x"])), key=lambda r: r[0])
    y = np.array([r["q"] for _, r in got])
    k = 3 * SHAPES + 2
    prior = 0.5 if prior is None else float(prior)
    if len(set(y.tolist())) < 2:
        return Crf(np.zeros(k), np.zeros((2, 2)), (1e-3, float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))), prior)
    model = fit([np.frombuffer(r["x"], np.float32).reshape(-1, k) for _, r in got], y,
                [np.frombuffer(r["c"], float) for _, r in got])
    return Crf(model.emit, model.step, model.curve, prior)


def scored(docs: DataFrame, model: Crf, text_col: str = "text", out: str = "score") -> DataFrame:
    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.round(model.score(texts), 6), dtype=float)

    return docs.withColumn(out, run.asNondeterministic()(F.col(text_col)))


def op6_line_crf(spark: SparkSession, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                      (F.col("score") >= threshold).cast("int").alias("predicted"))
