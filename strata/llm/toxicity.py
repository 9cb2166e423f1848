"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are densities of an insult lexicon (a fixed list, plain and obfuscated
spellings, and words and word beginnings learned from labelled texts), how near
insults stand to second-person words, capitals, punctuation and the rate of
obfuscated words.  Trees of depth three grow on histograms of the
features; isotonic regression on out-of-fold predictions turns their sums into
probabilities.

Null and empty texts have no words and are scored like any other; long texts
are read whole; repeated rows score alike; an empty table gives an empty table;
without labelled rows of both classes every score is the known share of label 1
(0.5 if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.labelled import TRAIN_ROWS, bin_edges, binned, held_out, matrix, sigmoid, training_sample
from strata.llm.words import (
    BYTES, Texts, Words, bounded_batches, byte_class, hash_words, merged, mix, parts, row_sums, words_of,
)
from strata.session import settle

#: Insults, lower case.
LEXICON = (
    "idiot", "idiots", "stupid", "moron", "morons", "pathetic", "disgusting", "worthless", "trash",
    "scum", "loser", "losers", "clown", "clowns", "dumb", "imbecile", "filthy", "garbage", "vermin",
    "jerk", "fool", "ugly", "freak", "creep", "coward", "crap", "bastard", "dumbass", "shut",
    "idiota", "estúpido", "imbécil", "basura", "asqueroso", "payaso", "inútil", "patético",
    "idiote", "stupide", "imbécile", "ordure", "crétin", "abruti", "débile", "pathétique",
    "dummkopf", "blöd", "abschaum", "trottel", "versager", "widerlich", "erbärmlich", "müll",
)
#: Words that address the reader.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "ihr", "euch",
    "tu", "te", "toi", "vous", "votre", "ton", "ti", "usted", "ustedes", "vosotros",
)
#: Signs that stand for letters in disguised words.
STAND_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FEATURES = (
    "learned_weight", "learned_density", "log_learned", "log_hits", "hit_density", "log_disguised", "disguised_density", "nearness", "near_hits",
    "second_person", "capitals", "shouted", "exclamations", "questions", "stops", "symbols",
    "mixed_words", "log_words",
)

_ALPHA = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0x80)
_UPPER = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_MARK = byte_class("".join(STAND_FOR) + "*")
_WORD_GAP = ~_ALPHA
_LOOSE_GAP = ~(_ALPHA | _MARK)
_LOOSE = merged(BYTES, STAND_FOR)
_INSULTS = np.sort(hash_words(list(LEXICON)))
_MASKED = np.sort(
    np.concatenate(
        [_INSULTS]
        + [hash_words([w[:i] + "*" + w[i + 1 :] for i in range(1, len(w) - 1)]) for w in LEXICON if len(w) > 3]
    )
)
_YOU = np.sort(hash_words(list(SECOND_PERSON)))
NEAR = 8
#: Bounds of what is learned from: labelled texts of label 1 and 0, entries kept.
LEXICON_ROWS = (3_000, 9_000)
LEXICON_SIZE = 2_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEMS = (5, 6, 7, 8)


@dataclass
class Lexicon:
    """Learned keys of words and word beginnings, sorted, with their weights."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


def _word_keys(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every word and of its first 5 to 8 bytes, and which of them exist."""
    at = words.begin[:, None] + np.arange(8)
    inside = at < words.end[:, None]
    first = np.where(inside, _LOWER[texts.data[np.minimum(at, max(len(texts.data) - 1, 0))]], 0)
    packed = np.ascontiguousarray(first.astype(np.uint8)).view("<u8").ravel()
    size = words.end - words.begin
    keys, real = [words.hash], [size >= 4]
    for k in _STEMS:
        mask = np.uint64((1 << 8 * k) - 1)
        keys.append(mix((packed & mask) + np.uint64(k << 56)))
        real.append(size >= k)
    return np.column_stack(keys), np.column_stack(real)


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct keys of each text, counted per label within the batch."""
    for batch in batches:
        label, done = batch.column("y").to_numpy(), 0
        for texts in parts(batch.column("text")):
            words = words_of(texts, _WORD_GAP)
            keys, real = _word_keys(texts, words)
            row = np.repeat(words.row, keys.shape[1])[real.ravel()]
            pair = np.unique(np.column_stack([row.astype(np.uint64), keys.ravel()[real.ravel()]]), axis=0)
            y = label[done + pair[:, 0].astype(np.int64)]
            key, at = np.unique(pair[:, 1], return_inverse=True)
            done += texts.rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(np.bincount(at, y, len(key)).astype(np.int64)),
                    pa.array(np.bincount(at, 1 - y, len(key)).astype(np.int64)),
                ],
                names=["key", "ones", "zeros"],
            )


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
    rows: tuple[int, int] = LEXICON_ROWS, size: int = LEXICON_SIZE,
) -> Lexicon:
    """Words and beginnings that stand in texts of label 1 far more often than by chance.

    Learns from at most ``rows`` labelled texts of each label, none held out,
    chosen by a hash of the id; equal texts count once.  Kept are at most
    ``size`` entries whose likelihood ratio exceeds what the number of
    candidate entries would bring about by chance.
    """
    known = labels.where(~held_out(id_col)).select(id_col, F.col(label_col).cast("int").alias("y"))
    chosen = [
        known.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(n) for y, n in zip((1, 0), rows, strict=True)
    ]
    # at most sum(rows) short rows, so broadcasting them is safe at any size
    picked = docs.select(id_col, F.col(text_col).alias("text")).join(
        F.broadcast(chosen[0].unionByName(chosen[1])), id_col
    )
    unlike = picked.select("text", "y").dropDuplicates()
    counts = settle(
        unlike.mapInArrow(_key_counts, "key long, ones long, zeros long")
        .groupBy("key")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")),
        "lexicon",
    )
    total = settle(unlike.groupBy("y").count(), "lexicon_rows").toPandas().set_index("y")["count"]
    n1, n0 = int(total.get(1, 0)), int(total.get(0, 0))
    if not n1 or not n0:
        return Lexicon()
    share, n = n1 / (n1 + n0), F.col("ones") + F.col("zeros")
    rate = F.col("ones") / n
    ratio = F.col("ones") * F.log(rate / share) + F.when(
        F.col("zeros") > 0, F.col("zeros") * F.log((1 - rate) / (1 - share))
    ).otherwise(0.0)
    least = float(np.log(max(counts.count(), 2)) + 3)
    best = (
        counts.where(rate > (1 + share) / 2)
        .where(ratio > least)
        .orderBy(ratio.desc(), "key")
        .limit(size)
        .toPandas()
    )
    keys = best["key"].to_numpy(np.int64).view(np.uint64)
    weights = np.log((best["ones"] + 0.5) / (n1 + 1)) - np.log((best["zeros"] + 0.5) / (n0 + 1))
    order = np.argsort(keys)
    return Lexicon(keys[order], np.clip(weights.to_numpy(float), 0, 5)[order])


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _learned(texts: Texts, words: Words, lexicon: Lexicon) -> np.ndarray:
    """The largest weight of each word's keys, 0 for words without an entry."""
    if not len(lexicon.keys) or not len(words.hash):
        return np.zeros(len(words.hash))
    keys, real = _word_keys(texts, words)
    at = np.minimum(np.searchsorted(lexicon.keys, keys), len(lexicon.keys) - 1)
    return np.where(real & (lexicon.keys[at] == keys), lexicon.weights[at], 0).max(1)


def _features(texts: Texts, lexicon: Lexicon) -> np.ndarray:
    plain = words_of(texts, _WORD_GAP)
    weight = _learned(texts, plain, lexicon)
    loose = words_of(texts, _LOOSE_GAP, _LOOSE)
    rows = texts.rows
    n = np.diff(plain.first).astype(float)
    some, chars = np.maximum(n, 1), np.maximum(np.diff(texts.start), 1)
    marks = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(_MARK[texts.data], out=marks[1:])
    alpha = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(_ALPHA[texts.data], out=alpha[1:])
    # a sign counts as disguise where a letter follows it within the word
    inner = marks[np.maximum(loose.end - 1, loose.begin)] - marks[loose.begin]
    mixed = (inner > 0) & (alpha[loose.end] > alpha[loose.begin] + 1)
    disguised = mixed & _member(loose.hash, _MASKED)
    hit = _member(plain.hash, _INSULTS)
    learned = np.bincount(plain.row, weight > 0, rows)
    you = np.flatnonzero(_member(plain.hash, _YOU))
    at = np.flatnonzero(hit | (weight > 0))
    nearness = np.zeros(rows)
    near = np.zeros(rows)
    if len(at) and len(you):
        after = np.minimum(np.searchsorted(you, at), len(you) - 1)
        for side in (after, np.maximum(after - 1, 0)):
            gap = np.abs(you[side] - at)
            value = np.where(plain.row[you[side]] == plain.row[at], 1 / (1 + gap), 0)
            np.maximum.at(nearness, plain.row[at], value)
        np.add.at(near, plain.row[at], nearness[plain.row[at]] >= 1 / (1 + NEAR))
    upper = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(_UPPER[texts.data], out=upper[1:])
    length = plain.end - plain.begin
    shouted = (length > 2) & (upper[plain.end] - upper[plain.begin] == length)
    hits = np.bincount(plain.row[hit], minlength=rows)
    masked = np.bincount(loose.row[disguised], minlength=rows)
    letters = np.maximum(row_sums(texts, _ALPHA), 1)
    return np.column_stack(
        [
            np.bincount(plain.row, weight, rows),
            learned / some,
            np.log1p(learned),
            np.log1p(hits),
            hits / some,
            np.log1p(masked),
            masked / some,
            nearness,
            near / some,
            np.bincount(plain.row[you], minlength=rows) / some,
            np.diff(upper[texts.start]) / letters,
            np.bincount(plain.row, shouted, rows) / some,
            row_sums(texts, byte_class("!")) / chars,
            row_sums(texts, byte_class("?")) / chars,
            row_sums(texts, byte_class(".,;:")) / chars,
            row_sums(texts, byte_class("#$%&*+<=>@^_|~")) / chars,
            np.bincount(loose.row, mixed, rows) / some,
            np.log1p(n),
        ]
    )


def _feature_column(lexicon: Lexicon) -> Column:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def features(column: pa.Array) -> pa.Array:
        blocks = [_features(texts, lexicon) for texts in parts(column)]
        values = np.concatenate(blocks) if blocks else np.zeros((0, len(FEATURES)))
        offsets = np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return features


@dataclass
class BoostedTrees:
    """Trees as arrays per level order: split feature, split bin, leaf values."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    levels: np.ndarray = field(default_factory=lambda: np.array([-30.0, 30.0]))
    chances: np.ndarray | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            bins = binned(x, self.edges)
            for feature, cut, leaf in self.trees:
                total += leaf[_leaves(bins, feature, cut)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return sigmoid(raw) if self.chances is None else np.interp(raw, self.levels, self.chances)


def _leaves(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The leaf of each row: at node k the row goes on to 2k + 1 or 2k + 2."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(int(np.log2(len(feature) + 1))):
        node = 2 * node + 1 + (bins[rows, feature[node]] >= cut[node])
    return node - len(feature)


def _grow(
    bins: np.ndarray, grad: np.ndarray, weight: np.ndarray, sizes: list[int], depth: int, ridge: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inner = 2**depth - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, max(sizes), np.int64)
    node = np.zeros(len(bins), np.int64)
    for level in range(depth):
        first, width = 2**level - 1, 2**level
        best = np.full(width, 1e-6)
        for f, size in enumerate(sizes):
            if size < 2:
                continue
            cell = (node - first) * size + bins[:, f]
            g = np.bincount(cell, grad, width * size).reshape(width, size).cumsum(1)
            w = np.bincount(cell, weight, width * size).reshape(width, size).cumsum(1)
            all_g, all_w = g[:, -1:], w[:, -1:]
            gain = (
                g[:, :-1] ** 2 / (w[:, :-1] + ridge)
                + (all_g - g[:, :-1]) ** 2 / (all_w - w[:, :-1] + ridge)
                - all_g**2 / (all_w + ridge)
            )
            k = gain.argmax(1)
            better = gain[np.arange(width), k] > best
            best = np.where(better, gain[np.arange(width), k], best)
            feature[first : first + width][better] = f
            cut[first : first + width][better] = k[better] + 1
        node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] >= cut[node])
    leaf = node - inner
    g, w = np.bincount(leaf, grad, 2**depth), np.bincount(leaf, weight, 2**depth)
    return feature, cut, g / (w + ridge)


def _boost(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, ridge: float) -> BoostedTrees:
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = BoostedTrees(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = bin_edges(x)
    bins, sizes = binned(x, model.edges), [len(e) + 1 for e in model.edges]
    total = np.full(len(y), model.base)
    for _ in range(trees):
        p = sigmoid(total)
        feature, cut, leaf = _grow(bins, y - p, p * (1 - p), sizes, depth, ridge)
        leaf = rate * leaf
        model.trees.append((feature, cut, leaf))
        total += leaf[_leaves(bins, feature, cut)]
    return model


def isotonic(level: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step fit of ``y`` by ``level`` (pool adjacent violators)."""
    order = np.argsort(level, kind="stable")
    pools: list[list[float]] = []
    for z, target in zip(level[order], y[order], strict=True):
        pools.append([float(target), 1.0, float(z), float(z)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, count, _, high = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += count
            pools[-1][3] = high
    levels = np.array([limit for total, count, low, high in pools for limit in (low, high)])
    means = [total / count for total, count, _, _ in pools]
    return levels, np.repeat(means, 2)


def fit_toxicity(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
    ridge: float = 2.0, folds: int = 4,
) -> BoostedTrees:
    """Boosted trees on one bounded sample, calibrated on out-of-fold predictions."""
    model = _boost(x, y, trees, depth, rate, ridge)
    if not model.trees:
        return model
    fold = np.arange(len(y)) % folds
    out = np.zeros(len(y))
    for k in range(folds):
        part = fold == k
        out[part] = _boost(x[~part], y[~part], trees, depth, rate, ridge).raw(x[part])
    model.levels, model.chances = isotonic(out, y)
    return model


def _scorer(model: BoostedTrees) -> Column:
    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(column)))

    return score


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", threshold: float = 0.7, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` and ``predicted``.

    The model is fitted on at most ``train_rows`` labelled rows, none of them
    held out; every row is scored.
    """
    bounded_batches(docs.sparkSession)
    lexicon = learn_lexicon(docs, labels, id_col, text_col, label_col)
    featured = settle(
        docs.select(F.col(id_col), _feature_column(lexicon)(F.col(text_col)).alias("features")), "toxicity"
    )
    model = fit_toxicity(*training_sample(featured, labels, id_col, label_col, train_rows))
    return featured.select(
        id_col,
        held_out(id_col).alias("held_out"),
        _scorer(model)("features").alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
