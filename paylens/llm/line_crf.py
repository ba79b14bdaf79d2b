"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. The score of a labelling is a sum of line weights (features of the line and of its
two neighbours) and transition weights between labels of adjacent lines. Forward and backward passes give each line's
marginal probability of being good; the mean of the marginals, weighted by line length, is the text's raw quality, and a
logistic curve fitted on the same training texts turns it into the probability that the text is labelled good.

Weights are fitted on a bounded sample of labelled texts whose lines all carry the text's label. The features are
counted in Spark tasks; the driver gets a bounded number of short vectors and maximises the likelihood.
"""

from __future__ import annotations

import math
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import held_out, pick, small_batches

FEATURES = ("one", "log_chars", "log_words", "symbols", "caps", "bare", "repeats", "stutter", "shouts", "copy", "word_size",
            "ends")
WIDTH = len(FEATURES)
SYMBOLS = "#*$%&|<>"
PARAMETERS = 3 * WIDTH + 4  # line, previous and next line; transitions bad-bad, bad-good, good-bad, good-good
THRESHOLD = 0.3
DOCS_AT_ONCE = 512

_LOWER, _UPPER, _MARKS = re.compile("[a-z]"), re.compile("[A-Z]"), re.compile(r"[!-/:-@\[-`{-~]+")


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, line lengths + 1) of a text; a null text is one empty line."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    out = np.zeros((len(lines), WIDTH), np.float32)
    sizes = np.fromiter(map(len, lines), np.float64, len(lines)) + 1
    for at, line in enumerate(lines):
        words = line.split()
        if not words:
            out[at, 0] = 1
            continue
        n, k = len(line), len(words)
        odd = [w for w in words if not _LOWER.search(w)]
        out[at] = (1, math.log(n) / 5, math.log(k) / 3, min(5 * sum(map(line.count, SYMBOLS)) / n, 1),
                   sum(1 for w in odd if _UPPER.search(w)) / k, min(4 * sum(1 for w in odd if _MARKS.fullmatch(w)) / k, 1),
                   1 - len(set(words)) / k, sum(map(operator.eq, words, words[1:])) / k, line.count("!") / k,
                   line in seen, min(n / k, 30) / 10, line[-1] in ".!?")
        seen.add(line)
    return out, sizes


def emissions(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of "good" minus "bad" for every line of one text."""
    w = weights[:3 * WIDTH].reshape(3, WIDTH)
    score = features @ w[0]
    score[1:] += features[:-1] @ w[1]
    score[:-1] += features[1:] @ w[2]
    return score


def _padded(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(position x text) scores and a mask; texts in order of falling length, so each position is a prefix of them."""
    longest = len(scores[0])
    grid = np.zeros((longest, len(scores)))
    for k, s in enumerate(scores):
        grid[:len(s), k] = s
    alive = np.searchsorted(-np.array([len(s) for s in scores]), -np.arange(longest), side="left")
    return grid, alive


def marginals(scores: list[np.ndarray], trans: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per text (in order of falling length): marginal of "good" of each line; and the expected transitions and
    log-partition of all texts. Forward and backward run over positions, for all texts at once."""
    grid, alive = _padded(scores)
    length, count = grid.shape
    sizes = np.array([len(s) for s in scores])
    t = trans.reshape(2, 2)
    fwd, bwd = np.zeros((length, count, 2)), np.zeros((length, count, 2))
    fwd[0, :, 1] = grid[0]
    for j in range(1, length):
        n = alive[j]
        step = np.logaddexp(fwd[j - 1, :n, 0, None] + t[0], fwd[j - 1, :n, 1, None] + t[1])
        step[:, 1] += grid[j, :n]
        fwd[j, :n] = step
    z = np.logaddexp(*fwd[sizes - 1, np.arange(count)].T)
    pairs = np.zeros((2, 2))
    for j in range(length - 1, 0, -1):
        n = alive[j]
        here = bwd[j, :n].copy()
        here[:, 1] += grid[j, :n]
        bwd[j - 1, :n] = np.logaddexp(t[:, 0] + here[:, 0, None], t[:, 1] + here[:, 1, None])
        pairs += np.exp(fwd[j - 1, :n, :, None] + t + here[:, None, :] - z[:n, None, None]).sum(0)
    good = np.exp(np.minimum(fwd[:, :, 1] + bwd[:, :, 1] - z, 0))
    return [good[:s, k] for k, s in enumerate(sizes)], pairs, z


@dataclass
class Crf:
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def lines(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Marginal of "good" of every line of each text."""
        out = [np.empty(0)] * len(parts)
        order = sorted(range(len(parts)), key=lambda k: -len(parts[k][1]))
        at = 0
        while at < len(order):
            longest = len(parts[order[at]][1])
            some = order[at:at + max(1, min(256, 200_000 // longest))]  # bounds the padded grid
            found, _, _ = marginals([emissions(parts[k][0], self.weights) for k in some], self.weights[3 * WIDTH:])
            for k, good in zip(some, found, strict=True):
                out[k] = good
            at += len(some)
        return out

    def raw(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted mean marginal of each text."""
        means = [good @ sizes / sizes.sum() for good, (_, sizes) in zip(self.lines(parts), parts, strict=True)]
        return np.clip(means, 1e-9, 1 - 1e-9)

    def scores(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        raw = self.raw(parts)
        return 1 / (1 + np.exp(-(self.slope * np.log(raw / (1 - raw)) + self.shift)))


def train(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 300, rate: float = 0.1,
          penalty: float = 0.005) -> Crf:
    """Maximum likelihood with a quadratic penalty, by full-batch Adam. Without labels of both kinds the score is the
    share of good labels, or one half."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return Crf(np.zeros(PARAMETERS), 0.0, math.log((share * 0.98 + 0.01) / (0.99 - share * 0.98)))
    order = sorted(range(len(parts)), key=lambda k: -len(parts[k][1]))
    feats, y = [parts[k][0].astype(float) for k in order], labels[order]
    flat = np.vstack(feats)
    edge = np.cumsum([0, *map(len, feats)])
    before, after = np.zeros_like(flat), np.zeros_like(flat)
    for a, b in zip(edge, edge[1:], strict=False):
        before[a + 1:b], after[a:b - 1] = flat[a:b - 1], flat[a + 1:b]
    x = np.hstack([flat, before, after])
    wanted = np.repeat(y, np.diff(edge)).astype(float)
    lines = len(flat)
    seen = np.zeros((2, 2))
    for k, f in enumerate(feats):
        seen[y[k], y[k]] += len(f) - 1
    weights, m, v = np.zeros(PARAMETERS), np.zeros(PARAMETERS), np.zeros(PARAMETERS)
    for step in range(1, steps + 1):
        score = x @ weights[:3 * WIDTH]
        found, pairs, _ = marginals([score[a:b] for a, b in zip(edge, edge[1:], strict=False)], weights[3 * WIDTH:])
        gradient = np.concatenate([x.T @ (wanted - np.concatenate(found)), (seen - pairs).ravel()]) / lines
        gradient -= penalty * weights / len(y) ** 0.5
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        weights = weights + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    model = Crf(weights)
    raw = model.raw(parts)
    z = np.log(raw / (1 - raw))
    smooth = (labels * len(labels) + 0.5) / (len(labels) + 1)
    design, curve = np.column_stack([z, np.ones(len(z))]), np.array([0.1, 0.0])
    for _ in range(50):  # logistic curve through the raw quality, with smoothed labels, by damped Newton steps
        p = 1 / (1 + np.exp(-design @ curve))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (smooth - p))
        curve = curve + step * min(1.0, 0.5 / np.abs(step).max())
    slope, shift = map(float, curve)
    return Crf(weights, max(slope, 1e-3), shift)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_docs: int = 4000, max_lines: int = 200) -> Crf:
    """Learn from labelled rows whose crc32(doc_id as text) mod 5 is not 0; labels other than 0 and 1 are ignored.

    The sample is bounded: about ``max_docs`` texts, those whose id hashes below the share wanted, and of these only
    texts with at most ``max_lines`` lines.
    """
    known = pick(labels, doc_id=doc_id, y=label).filter("y IN (0, 1)").filter(~held_out(F.col("doc_id"))).distinct()
    share = min(1.0, max_docs / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share))
    sample = F.broadcast(known)  # about max_docs ids

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, y, *line_features(t)) for i, t, y in zip(batch.doc_id, batch.text, batch.y, strict=True)
                    if (t or "").count("\n") < max_lines]
            yield pd.DataFrame({"doc_id": [r[0] for r in rows], "y": [r[1] for r in rows],
                                "x": [r[2].ravel().tolist() for r in rows], "sizes": [r[3].tolist() for r in rows]})

    joined = small_batches(pick(docs, doc_id=doc_id, text=text)).join(sample, "doc_id").dropDuplicates(["doc_id", "y", "text"])
    found = joined.select(F.col("doc_id").cast("string"), "text", "y").mapInPandas(
        count, "doc_id string, y int, x array<float>, sizes array<double>")
    rows = sorted(found.collect(), key=lambda r: (r.doc_id, r.y, r.x))  # about max_docs rows of at most max_lines lines
    parts = [(np.array(r.x, np.float32).reshape(-1, WIDTH), np.array(r.sizes)) for r in rows]
    return train(parts, np.array([r.y for r in rows], int))


def score(docs: DataFrame, model: Crf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted (1 if score >= THRESHOLD).

    A null or empty text is one empty line and gets a score as well. Texts are read whole, however many lines they have;
    repeated rows get the same score; an empty table gives an empty result; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = [sent.value.scores([line_features(t) for t in texts.iloc[at:at + DOCS_AT_ONCE]])
                   for at in range(0, len(texts), DOCS_AT_ONCE)]
            yield pd.Series(np.concatenate(out) if out else [], dtype=float)

    scored = small_batches(pick(docs, doc_id=doc_id, text=text)).select("doc_id", F.pandas_udf(run, "double")(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def label_lines(docs: DataFrame, model: Crf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line of every text: doc_id, line (from 0), chars, good (its marginal probability)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                some = batch.iloc[at:at + DOCS_AT_ONCE]
                parts = [line_features(t) for t in some.text]
                found = sent.value.lines(parts)
                yield pd.DataFrame({
                    "doc_id": some.doc_id.repeat([len(f) for f in found]).to_numpy(),
                    "line": np.concatenate([np.arange(len(f)) for f in found]),
                    "chars": np.concatenate([sizes for _, sizes in parts]).astype(int) - 1, "good": np.concatenate(found)})

    kept = small_batches(pick(docs, doc_id=doc_id, text=text)).select(F.col("doc_id").cast("string"), "text")
    return kept.mapInPandas(run, "doc_id string, line long, chars long, good double").withColumn(
        "doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
