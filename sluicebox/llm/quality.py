"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted cyclically, one feature at a time, on binned features; the trees of a feature add up to one
lookup table per feature, then the most useful pairs get a two-dimensional table each. A text is scored by adding the
entries its bins point at.

Defined results: null and empty texts have all-zero features and get the score of their bins; repeated rows get equal
results; an empty label table gives 0.5 everywhere and one with a single label gives that label. Only doc_id and text
are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import fit_labels, held_out, labelled_texts, map_texts, sigmoid

FIT_ROWS = 16_000
BINS = 32
ROUNDS = 120
PAIRS = 6
PAIR_BINS = 8
PAIR_ROUNDS = 60
RATE = 0.15
LEAVES = 3
THRESHOLD = 0.5
UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
DIGIT = re.compile(r"[0-9]")
SYMBOL = re.compile(r"[#*$%&|<>{}=~^\\]")
MARK = re.compile(r"[!?]")
STOP = re.compile(r"[.,;:]")
FEATURES = (
    "log_words mean_word std_word short_words long_words distinct_words repeated_pairs upper digits symbols marks stops "
    "log_lines dup_lines line_words ended_lines"
).split()


def features(text: str | None) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    words, chars = text.split(), len(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    mean = float(lengths.mean())
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log1p(n)),
        mean,
        float(lengths.std()),
        float((lengths <= 3).mean()),
        float((lengths >= 15).mean()),
        len(set(words)) / n**0.85,
        1.0 - pairs / max(1, n - 1),
        len(UPPER.findall(text)) / chars,
        len(DIGIT.findall(text)) / chars,
        len(SYMBOL.findall(text)) / chars,
        len(MARK.findall(text)) / chars,
        len(STOP.findall(text)) / chars,
        float(np.log1p(len(lines))),
        1.0 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        sum(line.rstrip()[-1:] in ".!?" for line in lines) / max(1, len(lines)),
    ]


def _leaf_table(gradient: np.ndarray, curvature: np.ndarray, leaves: int, penalty: float = 5.0) -> np.ndarray:
    """One tree over ordered bins: at most ``leaves`` leaves, split where the gain is highest; the value of each bin."""
    table = np.zeros(len(gradient))
    g, h = np.concatenate([[0.0], np.cumsum(gradient)]), np.concatenate([[0.0], np.cumsum(curvature)])
    parts = [(0, len(gradient))]

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + penalty)

    while len(parts) < leaves:
        best = (1e-6, None, None)
        for a, b in parts:
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                gains = worth(a, cuts) + (g[b] - g[cuts]) ** 2 / (h[b] - h[cuts] + penalty) - worth(a, b)
                k = int(gains.argmax())
                if gains[k] > best[0]:
                    best = (float(gains[k]), (a, b), int(cuts[k]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove(best[1])
        parts += [(a, best[2]), (best[2], b)]
    for a, b in parts:
        table[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return table


@dataclass
class AdditiveModel:
    """intercept plus one table per feature, plus one table per pair; edges hold the bin borders of each feature."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(edges, x[:, j], side="right") for j, edges in enumerate(self.pair_edges)]
            for (a, b), table in zip(self.pairs, self.pair_tables):
                out += table[coarse[a], coarse[b]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margins(x)) if len(x) else np.zeros(0)


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _binned_sums(bins: np.ndarray, size: int, residual: np.ndarray, weight: np.ndarray):
    return np.bincount(bins, residual, size), np.bincount(bins, weight, size)


def boost(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit the additive model; the row order does not matter beyond floating sums."""
    if not len(y):
        return AdditiveModel(0.0)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    if y.min() == y.max():
        return AdditiveModel(40.0 if y[0] else -40.0)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(edges) + 1) for edges in model.edges]
    bins = [np.searchsorted(edges, x[:, j], side="right") for j, edges in enumerate(model.edges)]
    margin = np.full(len(y), model.intercept)

    def update(cells: np.ndarray, size: int, grow: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        nonlocal margin
        p = sigmoid(margin)
        table = RATE * grow(*_binned_sums(cells, size, y - p, p * (1 - p)))
        margin = margin + table[cells]
        return table

    for _ in range(ROUNDS):
        for j, own in enumerate(bins):
            model.tables[j] += update(own, len(model.tables[j]), lambda g, h: _leaf_table(g, h, LEAVES))
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(edges, x[:, j], side="right") for j, edges in enumerate(model.pair_edges)]
    sizes = [len(edges) + 1 for edges in model.pair_edges]
    p = sigmoid(margin)
    gains = []
    for a, b in combinations(range(x.shape[1]), 2):
        g, h = _binned_sums(coarse[a] * sizes[b] + coarse[b], sizes[a] * sizes[b], y - p, p * (1 - p))
        gains.append((float((g**2 / (h + 5.0)).sum()), a, b))
    model.pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            cells = coarse[a] * sizes[b] + coarse[b]

            def grow(g, h, shape=(sizes[a], sizes[b])):
                g, h = g.reshape(shape), h.reshape(shape)
                return _quadrants(g, h).ravel()

            model.pair_tables[k] += update(cells, sizes[a] * sizes[b], grow).reshape(sizes[a], sizes[b])
    return model


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float = 5.0) -> np.ndarray:
    """A tree of depth two over a pair: the cross of cuts with the highest gain, one value per quadrant."""
    table = np.zeros_like(g)
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return table
    a, b = gs[:-1, :-1], hs[:-1, :-1]
    right_g, right_h = gs[:-1, -1:] - a, hs[:-1, -1:] - b
    low_g, low_h = gs[-1:, :-1] - a, hs[-1:, :-1] - b
    rest_g, rest_h = gs[-1, -1] - a - right_g - low_g, hs[-1, -1] - b - right_h - low_h
    gain = sum(u**2 / (v + penalty) for u, v in ((a, b), (right_g, right_h), (low_g, low_h), (rest_g, rest_h)))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            table[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + penalty)
    return table


def _feature_columns():
    return lambda texts: [[features(text) for text in texts]]


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on about ``rows`` labelled documents outside the held-out fold; the bound keeps them fit for one machine."""
    sample = labelled_texts(docs, fit_labels(labels, "quality", rows))
    found = map_texts(sample, _feature_columns, "x array<double>", keep="label").collect()
    return boost(np.array([r["x"] for r in found]).reshape(-1, len(FEATURES)), np.array([r["label"] for r in found], float))


def score(docs: DataFrame, model: AdditiveModel, keep: str = "doc_id") -> DataFrame:
    def start():
        return lambda texts: [model.scores(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))]

    return map_texts(docs, start, "score double", keep=keep)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
