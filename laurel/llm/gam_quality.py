"""Quality by a generalised additive model with pairwise interactions (operator 7).

Numbers that describe a text are cut into bins.  Boosting goes round the features again and
again: each turn fits a shallow tree on the bins of one feature and adds it to that
feature's lookup table; then the strongest pairs of features get tables the same way.  A
score is a sum of table entries.
"""

import operator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import bounded_sample

#: A labelled sample of at most this many rows is enough to fit some 20 small tables.
MOST_LABELLED = 20_000
FEATURES = [
    "log_bytes", "log_words", "word_bytes", "distinct_words", "repeated_words", "upper", "digits", "bars", "marks",
    "symbols", "stops", "commas", "wide", "line_bytes", "repeated_lines", "doubled", "short_words", "spaces",
]
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 60, 30, 0.15


def describe(text: str | None) -> list[float]:
    """The features of a text; a null one counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    code = np.frombuffer(raw, np.uint8)
    n = np.bincount(code, minlength=256)
    words = raw.split()
    many = max(len(words), 1)
    lines = raw.split(b"\n")
    letters = max(int(n[65:91].sum() + n[97:123].sum()), 1)
    symbols = int(n[[35, 36, 37, 38, 42, 64, 94, 95, 126]].sum())
    mark = (code[1:] == code[:-1]) & (code[1:] > 32) & (code[1:] < 64)
    return [
        np.log1p(len(raw)), np.log1p(len(words)), (size - n[32] - n[10]) / many, len(set(words)) / many,
        sum(map(operator.eq, words, words[1:])) / many, n[65:91].sum() / letters, n[48:58].sum() / size,
        n[124] / many, n[33] / many, symbols / many, n[46] / many, n[44] / many, n[128:].sum() / size,
        np.log1p(size / len(lines)), 1 - len(set(lines)) / len(lines), np.count_nonzero(mark) / many,
        sum(map((4).__gt__, map(len, words))) / many, (n[32] + n[9]) / size,
    ]


class Gam:
    """Cut points, tables and pair tables; ``raw`` adds up, ``score`` is the logistic of it."""

    def __init__(self, edges, start, tables, pairs):
        self.edges, self.start, self.tables, self.pairs = edges, start, tables, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        out = np.full(len(x), self.start)
        for i, t in enumerate(self.tables):
            out += t[bins[:, i]]
        coarse = self.coarse(bins)
        for i, j, t in self.pairs:
            out += t[coarse[:, i], coarse[:, j]]
        return out

    def coarse(self, bins: np.ndarray) -> np.ndarray:
        """Bins of the pair tables; a feature with few bins of its own keeps them all."""
        own = np.array([len(e) + 1 for e in self.edges])
        return np.where(own > PAIR_BINS, bins * PAIR_BINS // own, bins)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _best_split(g, h, lo, hi):
    """The cut of bins lo..hi that gains most: ``(gain, cut)``."""
    if hi - lo < 2:
        return 0.0, lo
    gs, hs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
    left = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
    at = int(left.argmax())
    return float(left[at] - gs[-1] ** 2 / (hs[-1] + 1)), lo + at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """The step of a tree of few leaves over one feature's bins, from gradient sums."""
    cuts = [(0, len(g))]
    while len(cuts) < leaves:
        options = [(*_best_split(g, h, lo, hi), lo, hi) for lo, hi in cuts]
        gain, at, lo, hi = max(options)
        if gain <= 1e-9:
            break
        cuts.remove((lo, hi))
        cuts += [(lo, at), (at, hi)]
    step = np.zeros(len(g))
    for lo, hi in cuts:
        step[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return step


def pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The step of a four-leaf tree over a pair: one cut of each feature."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, cut = -1.0, (1, 1)
    for a in range(1, len(g)):
        for b in range(1, len(g)):
            parts = [
                (gs[a - 1, b - 1], hs[a - 1, b - 1]),
                (gs[a - 1, -1] - gs[a - 1, b - 1], hs[a - 1, -1] - hs[a - 1, b - 1]),
                (gs[-1, b - 1] - gs[a - 1, b - 1], hs[-1, b - 1] - hs[a - 1, b - 1]),
            ]
            parts.append((gs[-1, -1] - sum(p[0] for p in parts), hs[-1, -1] - sum(p[1] for p in parts)))
            gain = sum(x * x / (y + 1) for x, y in parts)
            if gain > best:
                best, cut = gain, (a, b)
    a, b = cut
    step = np.zeros_like(g)
    for rows in (slice(0, a), slice(a, None)):
        for cols in (slice(0, b), slice(b, None)):
            step[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1)
    return step


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit on features and 0/1 labels.  Without rows, every score is a half."""
    if not len(y):
        return Gam([np.empty(0)] * len(FEATURES), 0.0, [np.zeros(BINS)] * len(FEATURES), [])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    share = np.clip(y.mean(), 0.01, 0.99)
    gam = Gam(edges, float(np.log(share / (1 - share))), [np.zeros(BINS) for _ in edges], [])
    bins = gam.bins(x)
    raw = np.full(len(y), gam.start)

    def slopes():
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i in range(len(edges)):
            g, h = (np.bincount(bins[:, i], v, BINS) for v in slopes())
            step = RATE * shallow_tree(g, h)
            gam.tables[i] += step
            raw += step[bins[:, i]]
    coarse = gam.coarse(bins)
    g, h = slopes()

    def sums(i, j, g, h):
        cell = coarse[:, i] * PAIR_BINS + coarse[:, j]
        return (np.bincount(cell, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in (g, h))

    strength = []
    for i in range(len(edges)):
        for j in range(i + 1, len(edges)):
            gs, hs = sums(i, j, g, h)
            strength.append((float((gs**2 / (hs + 1)).sum()), i, j))
    gam.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in sorted(strength, reverse=True)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in gam.pairs:
            step = RATE * pair_tree(*sums(i, j, *slopes()))
            t += step
            raw += step[coarse[:, i], coarse[:, j]]
    return gam


def describe_all(texts) -> np.ndarray:
    return np.array([describe(t) for t in texts], float).reshape(-1, len(FEATURES))


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Gam:
    """Fit on the documents of a bounded sample of ``labels`` (doc_id, quality).

    The sample is the ``most`` rows of smallest id hash, so it doesn't change with the order
    of rows.  Rows with a null id or label, or one other than 0 and 1, are not learned from.
    """
    rows = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select(
        F.col("doc_id").alias("labelled_id"), F.col("quality").cast("int").alias("label")
    )
    some = bounded_sample(rows, most, rows.count(), "labelled_id", "label")

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([describe(t) for t in texts])

    # the sample's ids are at most ``most`` pairs of numbers, so they may go to every task
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(some), F.col("doc_id") == F.col("labelled_id")
    )
    pairs = found.select("doc_id", features("text").alias("x"), "label").toPandas().sort_values(["doc_id", "label"])
    x = np.array(pairs["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, pairs["label"].to_numpy(float))


def quality_of(text, gam: Gam):
    """A score column from 0 to 1 for a text column; a null text is scored as an empty one."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(gam.score(describe_all(texts)))

    return score(text.cast("string"))
