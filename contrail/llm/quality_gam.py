"""Quality classifier: a generalised additive model with pairwise interactions.

Training boosts shallow trees over one binned feature at a time, cycling
through the features, so each feature ends as one lookup table (bin -> log
odds); then the strongest pairs of features get two-dimensional tables the
same way.  A score is the intercept plus one addition per table, made for all
texts of a batch at once, through the logistic function.

Inputs are counts over the whole text only.  Training reads at most
``SAMPLE`` labelled documents (the ones with the smallest id hash); the
sample and the tables (a few thousand numbers) are all that the driver holds.

Defined cases: a null text is scored as the empty text; labels that are null,
or of documents that are missing, are not used; a document with several
labels has their lowest; without labels every document scores 1, with labels
of one class their smoothed share.  Rows are independent: repeated rows score
alike, extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import textkernel as K
from contrail.llm.sampling import bounded

SAMPLE = 20_000
FEATURES = ("log_words", "word_chars", "symbols", "exclamations", "upper", "digits", "stops",
            "distinct_words", "top_word", "repeated_windows", "repeated_lines", "words_per_line",
            "lone_signs", "non_ascii")


def _class(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_SYMBOL, _SHOUT, _STOP, _DIGIT = _class("#*$%&|<>"), _class("!"), _class(".,;:?"), _class("0123456789")
_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_HIGH = np.arange(256) >= 0x80
_FIRST = (np.arange(256) & 0xC0) != 0x80        # first byte of a code point


def features(column) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    parts = [_run_features(w) for w in K.runs(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def _run_features(w: K.Words) -> np.ndarray:
    owner = w.bytes_of()
    share = lambda a, b: a / np.maximum(b, 1)
    count = lambda table: w.per_doc(owner[table[w.data]])
    words, chars = w.per_doc(w.doc), count(_FIRST)
    word_chars = w.per_doc(owner[_FIRST[w.data] & ~w.space])
    line_ends = w.per_doc(owner[w.data == 10])
    own = w.hashes(w.start, w.end)
    d, _, n = K.weighted(w.doc, own)
    top = np.zeros(w.n)
    np.maximum.at(top, d, n)
    at, h = K.windows(w)
    wd, _, wn = K.weighted(w.doc[at], h)
    repeated = w.per_doc(wd, np.where(wn > 1, wn, 0))
    size = w.end - w.start
    lone = (size == 1) & ~_LETTER[w.data[w.start]] & ~_DIGIT[w.data[w.start]] if len(size) else size == 1
    lines, dup = repeated_lines(w)
    return np.column_stack([
        np.log1p(words), share(word_chars, words), share(count(_SYMBOL), words), share(count(_SHOUT), words),
        share(count(_UPPER), count(_LETTER)), share(count(_DIGIT), chars), share(count(_STOP), words),
        share(w.per_doc(d), words), share(top, words), share(repeated, w.per_doc(w.doc[at])),
        share(dup, lines), share(words, line_ends + 1), share(w.per_doc(w.doc[lone]), words),
        share(count(_HIGH), chars)])


def repeated_lines(w: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier line."""
    if len(w.data) == 0:
        return np.zeros(w.n, np.int64), np.zeros(w.n, np.int64)
    ends = np.flatnonzero(w.data == 10)
    start = np.union1d(w.at[:-1][np.diff(w.at) > 0], ends + 1)
    start = start[start < len(w.data)]
    stop = np.append(start[1:], len(w.data))
    stop = stop - (w.data[stop - 1] == 10)      # the line end is no part of the line
    inked = np.append(0, np.cumsum(~w.space))
    keep = inked[stop] > inked[start]
    start, stop = start[keep], stop[keep]
    doc = np.searchsorted(w.at, start, side="right") - 1
    d, _, n = K.weighted(doc, w.hashes(start, stop))
    return w.per_doc(doc), w.per_doc(d, n - 1).astype(np.int64)


@dataclass
class Gam:
    intercept: float = 0.0
    edges: list = field(default_factory=list)       # per feature: inner bin edges
    tables: list = field(default_factory=list)      # per feature: log odds of each bin
    pairs: list = field(default_factory=list)       # ((i, j), table)
    constant: float | None = None

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)]

    def log_odds(self, bins: list[np.ndarray]) -> np.ndarray:
        z = np.full(len(bins[0]), self.intercept)
        for b, t in zip(bins, self.tables):
            z += t[b]
        for (i, j), t in self.pairs:
            z += t[bins[i], bins[j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.log_odds(self.bins(x)), -30, 30)))


def _cut_gain(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[int, float]:
    """Best cut of a row of bins: left is [0, cut)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if len(gl) == 0:
        return 0, 0.0
    total_g, total_h = g.sum(), h.sum()
    gain = gl**2 / (hl + lam) + (total_g - gl)**2 / (total_h - hl + lam) - total_g**2 / (total_h + lam)
    k = int(np.argmax(gain))
    return k + 1, float(gain[k])


def _tree(g: np.ndarray, h: np.ndarray, depth: int, lam: float) -> np.ndarray:
    """Step of each bin by a tree over one feature."""
    cut, gain = _cut_gain(g, h, lam) if depth else (0, 0.0)
    if gain <= 1e-9:
        return np.full(len(g), -g.sum() / (h.sum() + lam))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1, lam), _tree(g[cut:], h[cut:], depth - 1, lam)])


def _pair_tree(g: np.ndarray, h: np.ndarray, lam: float) -> tuple[np.ndarray, float]:
    """A cut of the first feature and one of the second on each side."""
    cut, _ = _cut_gain(g.sum(1), h.sum(1), lam)
    out, gain = np.zeros_like(g), 0.0
    for side in (slice(0, cut), slice(cut, None)):
        if out[side].size:
            out[side] = _tree(g[side].sum(0), h[side].sum(0), 1, lam)
            gain += float(-(out[side][0] * g[side].sum(0)).sum())
    return out, gain


def train(x: np.ndarray, y: np.ndarray, max_bins: int = 32, rounds: int = 120, rate: float = 0.15,
          n_pairs: int = 4, pair_rounds: int = 40, lam: float = 2.0) -> Gam:
    if len(y) == 0:
        return Gam(constant=1.0)
    if y.min() == y.max():
        return Gam(constant=float((y.sum() + 0.5) / (len(y) + 1)))
    share = y.mean()
    m = Gam(float(np.log(share / (1 - share))))
    for k in range(x.shape[1]):
        edges = np.unique(np.quantile(x[:, k], np.arange(1, max_bins) / max_bins))
        m.edges.append(edges)
        m.tables.append(np.zeros(len(edges) + 1))
    bins = m.bins(x)
    z = np.full(len(y), m.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for k, b in enumerate(bins):
            g, h = slopes()
            n = len(m.tables[k])
            step = rate * _tree(np.bincount(b, g, n), np.bincount(b, h, n), 2, lam)
            m.tables[k] += step
            z += step[b]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        shape = len(m.tables[i]), len(m.tables[j])
        return np.bincount(bins[i] * shape[1] + bins[j], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h), lam)[1], -i, -j)
                    for i in range(len(bins)) for j in range(i + 1, len(bins))), reverse=True)
    pairs = [(-i, -j) for gain, i, j in gains[:n_pairs] if gain > 1e-9]
    tables = {p: np.zeros((len(m.tables[p[0]]), len(m.tables[p[1]]))) for p in pairs}
    for _ in range(pair_rounds):
        for i, j in pairs:
            g, h = slopes()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h), lam)[0]
            tables[i, j] += step
            z += step[bins[i], bins[j]]
    m.pairs = list(tables.items())
    return m


def feature_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def extract(texts: pa.Array) -> pa.Array:
        return pa.array(list(features(texts)), pa.list_(pa.float64()))

    return extract(text)


def score_column(text: Column, model: Gam) -> Column:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(features(texts)), pa.float64())

    return score(text)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Gam:
    """``labels``: doc_id, label (0 or 1).  At most ``sample`` documents."""
    chosen = bounded(labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
                     .groupBy("doc_id").agg(F.min("label").alias("label")), ["doc_id"], sample)
    # at most `sample` rows of two numbers: bounded, so it may be broadcast
    known = F.broadcast(chosen.select(F.col("doc_id").alias("_id"), F.col("label").alias("_label")))
    rows = (docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id"))
            .select("doc_id", "_label", feature_column(F.col("text")).alias("x"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).select("_label", "x").collect())
    x = np.array([r.x for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return train(x, np.array([float(r._label) for r in rows]))
