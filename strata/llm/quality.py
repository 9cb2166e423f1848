"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins; selected pairs of
features have tables over pairs of bins.  The tables are learned by cyclic
boosting: round after round, every feature in turn gets a shallow tree on the
remaining gradient, whose leaves are added into its table.  A score is the sum
of the table entries, through a logistic function, so scoring is a few gathers
and additions per row.

Features depend on the text alone.  Null and empty texts are texts without
words and are scored like any other; long texts are read whole; repeated rows
score alike; an empty table gives an empty table; without labelled rows of both
classes every score is the known share of label 1 (0.5 if there is none).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.labelled import TRAIN_ROWS, bin_edges, binned, held_out, matrix, sigmoid, training_sample
from strata.llm.words import Texts, bounded_batches, byte_class, parts, row_sums, words_of
from strata.session import settle

FEATURES = (
    "log_words", "mean_length", "long_words", "same_as_last", "distinct", "symbol_endings",
    "capitals", "digits", "stops", "symbols", "exclamations", "bars", "non_ascii", "lines",
    "sentence_words", "log_chars",
)
_UPPER = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGIT = byte_class("0123456789")
_STOP = byte_class(".,;:?")
_SYMBOL = byte_class("#$%&*+<=>@\\^_`{}~[]/")
_EXCLAIM = byte_class("!")
_BAR = byte_class("|")
_LINE = byte_class("\n")
_HIGH = np.arange(256) >= 0x80
_ENDING = _SYMBOL | _EXCLAIM | _BAR


def _features(texts: Texts) -> np.ndarray:
    words = words_of(texts)
    rows, n = texts.rows, np.diff(words.first).astype(float)
    size = np.diff(texts.start).astype(float)
    some, chars = np.maximum(n, 1), np.maximum(size, 1)
    length = (words.end - words.begin).astype(float)

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.row, values, rows)

    same = np.zeros(len(words.hash))
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    salted = words.hash ^ (words.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, seen = np.unique(salted, return_index=True)
    last = texts.data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    letters = np.maximum(row_sums(texts, _LETTER), 1)
    return np.column_stack(
        [
            np.log1p(n),
            per_row(length) / some,
            per_row(length > 16) / some,
            per_row(same) / some,
            np.bincount(words.row[seen], minlength=rows) / some,
            per_row(_ENDING[last]) / some,
            row_sums(texts, _UPPER) / letters,
            row_sums(texts, _DIGIT) / chars,
            row_sums(texts, _STOP) / chars,
            row_sums(texts, _SYMBOL) / chars,
            row_sums(texts, _EXCLAIM) / chars,
            row_sums(texts, _BAR) / chars,
            row_sums(texts, _HIGH) / chars,
            row_sums(texts, _LINE) / chars,
            n / (1 + per_row(last == ord("."))),
            np.log1p(size),
        ]
    )


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _feature_column(column: pa.Array) -> pa.Array:
    blocks = [_features(texts) for texts in parts(column)]
    values = np.concatenate(blocks) if blocks else np.zeros((0, len(FEATURES)))
    offsets = np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


@dataclass
class AdditiveModel:
    """Bin limits, one table per feature, one table per chosen pair."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            bins = binned(x, self.edges)
            for f, table in enumerate(self.tables):
                total += table[bins[:, f]]
            for i, j, table in self.pairs:
                total += table[bins[:, i], bins[:, j]]
        return sigmoid(total)


def _shallow_tree(grad: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values per bin of a tree with up to ``leaves`` leaves over ordered bins."""
    limits = [(0, len(grad))]
    while len(limits) < leaves:
        best = (1e-9, None, 0)
        for leaf, (lo, hi) in enumerate(limits):
            if hi - lo < 2:
                continue
            g, w = np.cumsum(grad[lo:hi]), np.cumsum(weight[lo:hi])
            left = g[:-1] ** 2 / (w[:-1] + ridge)
            right = (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + ridge)
            gain = left + right - g[-1] ** 2 / (w[-1] + ridge)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], leaf, lo + k + 1)
        if best[1] is None:
            break
        lo, hi = limits.pop(best[1])
        limits += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(grad))
    for lo, hi in limits:
        out[lo:hi] = grad[lo:hi].sum() / (weight[lo:hi].sum() + ridge)
    return out


def _quadrants(grad: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of a grid of bins into four, with its gain and leaf values."""
    g, w = grad.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)

    def leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a**2 / (b + ridge)

    a, wa = g[:-1, :-1], w[:-1, :-1]
    b, wb = g[:-1, -1:] - a, w[:-1, -1:] - wa
    c, wc = g[-1:, :-1] - a, w[-1:, :-1] - wa
    d, wd = g[-1, -1] - a - b - c, w[-1, -1] - wa - wb - wc
    gain = leaf(a, wa) + leaf(b, wb) + leaf(c, wc) + leaf(d, wd)
    if not gain.size:
        return 0.0, np.zeros_like(grad)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(grad)
    out[: i + 1, : j + 1] = a[i, j] / (wa[i, j] + ridge)
    out[: i + 1, j + 1 :] = b[i, j] / (wb[i, j] + ridge)
    out[i + 1 :, : j + 1] = c[i, j] / (wc[i, j] + ridge)
    out[i + 1 :, j + 1 :] = d[i, j] / (wd[i, j] + ridge)
    return float(gain[i, j]), out


def fit_additive(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, pair_rounds: int = 20, n_pairs: int = 6,
    rate: float = 0.15, leaves: int = 4, ridge: float = 2.0,
) -> AdditiveModel:
    """Cyclic boosting on one bounded sample; pairs are ranked by what they still explain."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return AdditiveModel(base)
    edges = bin_edges(x)
    bins = binned(x, edges)
    sizes = [len(e) + 1 for e in edges]
    tables = [np.zeros(s) for s in sizes]
    total = np.full(len(y), base)
    for _ in range(rounds):
        for f, table in enumerate(tables):
            p = sigmoid(total)
            grad = np.bincount(bins[:, f], y - p, sizes[f])
            step = rate * _shallow_tree(grad, np.bincount(bins[:, f], p * (1 - p), sizes[f]), leaves, ridge)
            table += step
            total += step[bins[:, f]]
    grids = {
        (i, j): (bins[:, i] * sizes[j] + bins[:, j])
        for i in range(len(sizes))
        for j in range(i + 1, len(sizes))
        if sizes[i] > 1 and sizes[j] > 1
    }

    def quadrants(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        p, shape = sigmoid(total), (sizes[pair[0]], sizes[pair[1]])
        grad = np.bincount(grids[pair], y - p, shape[0] * shape[1]).reshape(shape)
        weight = np.bincount(grids[pair], p * (1 - p), shape[0] * shape[1]).reshape(shape)
        return _quadrants(grad, weight, ridge)

    ranked = sorted(grids, key=lambda pair: -quadrants(pair)[0])[:n_pairs]
    pairs = {pair: np.zeros((sizes[pair[0]], sizes[pair[1]])) for pair in ranked}
    for _ in range(pair_rounds):
        for pair, table in pairs.items():
            step = rate * quadrants(pair)[1]
            table += step
            total += step.ravel()[grids[pair]]
    return AdditiveModel(base, edges, tables, [(i, j, t) for (i, j), t in pairs.items()])


def _scorer(model: AdditiveModel) -> Column:
    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(column)))

    return score


def _fitted(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_rows: int
) -> tuple[DataFrame, AdditiveModel]:
    """Stored features of every row, and the model of the labelled ones."""
    bounded_batches(docs.sparkSession)
    featured = settle(
        docs.select(F.col(id_col), _feature_column(F.col(text_col)).alias("features")), "quality"
    )
    return featured, fit_additive(*training_sample(featured, labels, id_col, label_col, train_rows))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", threshold: float = 0.5, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` and ``predicted``.

    The model is fitted on at most ``train_rows`` labelled rows, none of them
    held out; every row is scored.
    """
    featured, model = _fitted(docs, labels, id_col, text_col, label_col, train_rows)
    return featured.select(
        id_col,
        held_out(id_col).alias("held_out"),
        _scorer(model)("features").alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", threshold: float = 0.5, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that ``score_quality`` predicts as 1, all columns.

    Features are computed once more where the rows stand, which moves no text.
    """
    _, model = _fitted(docs, labels, id_col, text_col, label_col, train_rows)
    return docs.where(_scorer(model)(_feature_column(F.col(text_col))) >= threshold)
