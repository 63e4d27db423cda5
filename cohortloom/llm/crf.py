"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of character classes, repetition
within the line and within the document, and the same numbers of the lines before and
after it; two transition weights tie neighbours together. Exact forward-backward
marginals, weighted by line length, give the good share of a document, and a logistic
curve turns that share and the worst line into a score.

Only documents are labelled. The field is first fitted with every line labelled as
its document, then again with the lines of bad documents relabelled by their own
marginals, at least one of each staying bad. The fit uses a bounded sample: at most
`sample` documents of at most MAX_LINES lines each.

Defined cases: a null or blank text has no lines and scores the share of good
documents in the sample. Rows with equal or null ids are scored one by one. Columns
other than the text are never read. Without documents of both labels in the sample
every score is that share, or 1 without any.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of

MAX_LINES = 120
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?")
STOPS = b".,;:?!"
BASE_FEATURES = 13


def lines_of(text: str) -> list[str]:
    return [line for line in text.split("\n") if line and not line.isspace()]


def describe(lines: list[str]) -> np.ndarray:
    """A row of numbers between 0 and about 1 for each line."""
    times = Counter(lines)
    out = np.empty((len(lines), BASE_FEATURES), dtype=np.float32)
    for i, line in enumerate(lines):
        raw, words = line.encode("utf-8", "replace"), line.split()
        size, n = len(raw), len(words)
        upper = size - len(raw.translate(None, UPPER))
        symbols = size - len(raw.translate(None, SYMBOLS))
        digits = size - len(raw.translate(None, DIGITS))
        stops = size - len(raw.translate(None, STOPS))
        distinct = len(set(words))
        repeats = sum(map(eq, words, words[1:]))
        out[i] = (
            min(size, 2000) / 2000,
            min(n, 20) / 20,
            upper / size,
            symbols / size,
            digits / size,
            min(1.0, stops / n),
            1 - distinct / n,
            repeats / n,
            min(1.0, size / n / 20),
            1 - 1 / times[line],
            line[-1] in ".!?",
            line[0].isupper(),
            min(1.0, 10 * symbols / size),
        )
    return out


def expand(base: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Own, previous and next features of every line, with square roots, document edges and a constant."""
    starts = np.cumsum(sizes) - sizes
    own = np.hstack([base, np.sqrt(base[:, 2:10])])
    before, after = np.vstack([own[:1] * 0, own[:-1]]), np.vstack([own[1:], own[:1] * 0])
    first, last = np.zeros(len(base)), np.zeros(len(base))
    first[starts], last[starts + sizes - 1] = 1, 1
    before[first > 0], after[last > 0] = 0, 0
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((len(base), 1))]).astype(np.float64)


class Chains:
    """Lines of documents laid out by position, so that one step handles a line of every document."""

    def __init__(self, sizes: np.ndarray) -> None:
        self.sizes = sizes
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        ranked = sizes[order]
        self.active = [int(k) for k in np.searchsorted(-ranked, -np.arange(1, ranked[0] + 1), side="right")]
        self.layout = np.concatenate([starts[:k] + t for t, k in enumerate(self.active)])
        self.edges = np.concatenate([[0], np.cumsum(self.active)])

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(label) of each line, expected counts of label pairs) for scores of shape (lines, 2) and (2, 2)."""
        score, edges = unary[self.layout], self.edges
        alpha, beta = np.empty_like(score), np.zeros_like(score)
        alpha[: edges[1]] = score[: edges[1]]
        for t in range(1, len(self.active)):
            prior = alpha[edges[t - 1] : edges[t - 1] + self.active[t]]
            step = np.logaddexp(prior[:, :1] + pair[0], prior[:, 1:] + pair[1])
            alpha[edges[t] : edges[t + 1]] = step + score[edges[t] : edges[t + 1]]
        for t in range(len(self.active) - 1, 0, -1):
            k = self.active[t]
            ahead = score[edges[t] : edges[t + 1]] + beta[edges[t] : edges[t + 1]]
            here = np.logaddexp(pair[:, 0] + ahead[:, :1], pair[:, 1] + ahead[:, 1:])
            beta[edges[t - 1] : edges[t - 1] + k] = here
        total = alpha + beta
        norm = np.logaddexp(total[:, 0], total[:, 1])
        expected = np.zeros((2, 2))
        for t in range(1, len(self.active)):
            k, a = self.active[t], edges[t - 1]
            ahead = score[edges[t] : edges[t + 1]] + beta[edges[t] : edges[t + 1]]
            joint = alpha[a : a + k, :, None] + pair + ahead[:, None, :] - norm[a : a + k, None, None]
            expected += np.exp(joint).sum(axis=0)
        out = np.empty_like(score)
        out[self.layout] = np.exp(total - norm[:, None])
        return out, expected

    def pairs(self, labels: np.ndarray) -> np.ndarray:
        """Counts of neighbouring labels."""
        inside = np.ones(len(labels), dtype=bool)
        inside[np.cumsum(self.sizes) - self.sizes] = False
        out = np.zeros((2, 2))
        np.add.at(out, (labels[np.flatnonzero(inside) - 1], labels[inside]), 1)
        return out


@dataclass
class LineField:
    """The fitted weights; label 0 is a bad line, 1 a good one. `unary` scores good against bad."""

    unary: np.ndarray | None
    pair: np.ndarray
    curve: np.ndarray
    prior: float

    def shares(self, base: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(length-weighted good share, P(good) of the worst line) of each document, as log odds, and a constant."""
        good = self.good(base, sizes)
        starts = np.cumsum(sizes) - sizes
        share = np.add.reduceat(good * lengths, starts) / np.add.reduceat(lengths, starts)
        worst = np.minimum.reduceat(good, starts)
        odds = [np.log(p / (1 - p)) for p in (np.clip(share, 1e-4, 1 - 1e-4), np.clip(worst, 1e-4, 1 - 1e-4))]
        return np.stack([*odds, np.ones(len(sizes))], axis=1)

    def good(self, base: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        score = expand(base, sizes) @ self.unary
        return Chains(sizes).marginals(np.stack([np.zeros_like(score), score], axis=1), self.pair)[0][:, 1]

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        split = [lines_of(text) for text in texts]
        some = [i for i, lines in enumerate(split) if lines]
        if self.unary is None or not some:
            return out
        base = np.vstack([describe(split[i]) for i in some])
        sizes = np.array([len(split[i]) for i in some])
        lengths = np.array([len(line) for i in some for line in split[i]], dtype=float)
        out[some] = 1 / (1 + np.exp(-(self.shares(base, sizes, lengths) @ self.curve)))
        return out


def _descend(gradient, weights: list[np.ndarray], rounds: int, rate: float) -> list[np.ndarray]:
    """Adam: step sizes from running means of the gradient and of its square."""
    mean, square = [w * 0 for w in weights], [w * 0 for w in weights]
    for step in range(1, rounds + 1):
        for i, g in enumerate(gradient(*weights)):
            mean[i] += 0.1 * (g - mean[i])
            square[i] += 0.001 * (g * g - square[i])
            weights[i] = weights[i] - rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(rows: DataFrame, rounds: int = 100, penalty: float = 1e-3) -> LineField:
    """Fit on (text, label) rows, whose number the caller has bounded; label 1 marks a good document."""

    def featured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, label in zip(frame["text"], frame["label"], strict=True):
                lines = lines_of(text)
                if 0 < len(lines) <= MAX_LINES:
                    out.append((int(label), describe(lines).tobytes(), np.array([len(x) for x in lines], "<f4").tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["label", "base", "lengths"])

    described = rows.select("text", "label").mapInPandas(featured, "label int, base binary, lengths binary")
    sample = sorted((r.label, bytes(r.base), bytes(r.lengths)) for r in described.collect())
    labels = np.array([r[0] for r in sample], dtype=int)
    prior = float(labels.mean()) if len(labels) else 1.0
    empty = LineField(None, np.zeros((2, 2)), np.zeros(3), prior)
    if len(set(labels.tolist())) < 2:
        return empty
    lengths = [np.frombuffer(r[2], "<f4").astype(float) for r in sample]
    sizes = np.array([len(x) for x in lengths])
    base, lengths = np.frombuffer(b"".join(r[1] for r in sample), np.float32).reshape(-1, BASE_FEATURES), np.concatenate(lengths)
    x, chains, owner = expand(base, sizes), Chains(sizes), np.repeat(np.arange(len(sizes)), sizes)
    line_labels = labels[owner]
    field = empty
    for _ in range(2):
        observed, total = chains.pairs(line_labels), len(line_labels)

        def gradient(unary, pair, y=line_labels, observed=observed, total=total):
            score = x @ unary
            p, expected = chains.marginals(np.stack([np.zeros_like(score), score], axis=1), pair)
            return x.T @ (p[:, 1] - y) / total + penalty * unary, (expected - observed) / total + penalty * pair

        unary, pair = _descend(gradient, [np.zeros(x.shape[1]), np.zeros((2, 2))], rounds, 0.1)
        field = LineField(unary, pair, empty.curve, prior)
        good = field.good(base, sizes)
        worst = np.minimum.reduceat(good, np.cumsum(sizes) - sizes)
        line_labels = np.where(labels[owner] == 1, 1, (good > np.maximum(0.5, worst[owner])).astype(int))
    shares = field.shares(base, sizes, lengths)

    def slope(curve):
        p = 1 / (1 + np.exp(-(shares @ curve)))
        return [shares.T @ (p - labels) / len(labels) + penalty * curve]

    field.curve = _descend(slope, [np.array([0.5, 0.5, 0.0])], 500, 0.05)[0]
    return field


def score(field: LineField, text_col: str = "text") -> Column:
    """The score of a text, between 0 and 1; higher is better."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            parts = [field.scores(series.iloc[at : at + 500].tolist()) for at in range(0, len(series), 500)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return scored(text_of(text_col))
