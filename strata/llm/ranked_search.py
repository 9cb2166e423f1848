"""Ranked lexical search by dense blocked matrix products.

Items (queries) are taken in passes of bounded size.  A pass reads every text
once and stores, per document, its length and the counts of the pass's terms.
From these come the document frequencies, and then the scores: items form tiles,
each with the compact vocabulary of its own items; documents form tiles of
impacts; a tile of item weights times a tile of impacts is one product of
float64 matrices.  Weights and impacts are whole numbers and a product adds up
few enough terms to stay below 2^53, so it is exact in any order; products of
further vocabulary are added as 64-bit integers.

The top of each item is kept per task with all scores that tie its last place
until ids decide, then combined over tasks in two steps, the first split by a
hash of the document, so an item's rows gather in no task.

Terms are maximal runs of ASCII letters and digits and of all other characters
beyond ASCII; A-Z count as a-z.  A term's weight is
floor(1000 ln((2N + 2) / (2 df + 1))), its impact in a document
10^9 tf div (1000 tf + 8 (100 - b + b n N div L)) with b = 90.

Null and empty texts have no terms and are found by nothing; long texts are read
whole; each row is a document, so repeated rows count and rank each; rows
without a document id rank behind others of the same score.  Rows that repeat
an item id form one item with the terms of all; items without a term have no
result; items without an id form one item.  Empty tables give an empty table;
other columns are not read.  Terms with equal 64-bit hashes count as equal.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.words import as_long, bounded_batches, byte_class, parts, texts_of, words_of
from strata.session import settle, struct

LENGTH_SHARE = 90
#: A pass has at most so many items and pairs of item and term (or is a single item).
PASS_ITEMS, PASS_PAIRS = 4_096, 1 << 20
#: Cells of a tile of weights, impacts or scores at most, items and documents of a tile.
TILE_CELLS, TILE_ITEMS, TILE_DOCS = 1 << 21, 256, 1_024
#: Impacts stay below this; with the largest weight it bounds the terms of one product.
IMPACT = 1_000_000
EXACT = 1 << 53
#: Parts into which an item's candidates are split before they are combined.
SALTS = 32

_GAP = np.ones(256, bool)
_GAP[128:] = False
_GAP &= ~byte_class("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")

_LONG = T.LongType()
POSTINGS = struct(doc_id=_LONG, n=_LONG, terms=T.ArrayType(T.IntegerType()), counts=T.ArrayType(T.IntegerType()))
FOUND = struct(item_id=_LONG, doc_id=_LONG, score=_LONG)
RANKED = struct(item_id=_LONG, rank=T.IntegerType(), doc_id=_LONG, score=_LONG)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of item and term hash."""
    for batch in batches:
        ids, done = batch.column(0), 0
        for texts in parts(batch.column(1)):
            words = words_of(texts, _GAP)
            of = ids.take(pa.array(words.row + done))
            yield pa.record_batch([of, pa.array(as_long(words.hash))], names=["item_id", "term"])
            done += texts.rows


@dataclass
class Items:
    """Items of one pass: their ids, the sorted hashes of their terms, and the pairs (item, term number)."""

    ids: list
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray


def _passes(items: DataFrame, most_items: int, most_pairs: int) -> Iterator[Items]:
    """Items in the order of their ids; only one pass is held at a time."""

    def packed(held: list[tuple]) -> Items:
        at = np.cumsum([1] + [a[0] != b[0] for a, b in zip(held, held[1:], strict=False)]) - 1
        ids = [x for i, (x, _) in enumerate(held) if i == 0 or at[i] != at[i - 1]]
        vocabulary, term = np.unique(np.array([h for _, h in held], np.int64).view(np.uint64), return_inverse=True)
        return Items(ids, vocabulary, at, term)

    held: list[tuple] = []
    one: list[tuple] = []
    n = 0

    for row in items.orderBy("item_id", "term").toLocalIterator():
        if one and row[0] != one[0][0]:
            held, n, one = held + one, n + 1, []
            if n >= most_items:
                yield packed(held)
                held, n = [], 0
        one.append((row[0], row[1]))
        if held and len(held) + len(one) > most_pairs:
            yield packed(held)
            held, n = [], 0
    if held or one:
        yield packed(held + one)


def _positions(vocabulary: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Look-up of hashes by their top bits, then by comparison; -1 for others."""
    bits = max(len(vocabulary) * 8, 16).bit_length()
    shift = np.uint64(64 - bits)
    starts = np.searchsorted(vocabulary >> shift, np.arange(1 << bits, dtype=np.uint64))
    deepest = int(np.diff(np.append(starts, len(vocabulary))).max(initial=0))
    padded = np.append(vocabulary, np.zeros(deepest + 1, np.uint64))

    def find(hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, np.int32)
        at = starts[(hashes >> shift).astype(np.int64)]
        for step in range(deepest):
            hit = (padded[at + step] == hashes) & (at + step < len(vocabulary))
            found[hit] = (at + step)[hit]
        return found

    return find


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document: its number of terms, and which of the vocabulary it holds how often."""
    find, size = _positions(vocabulary), len(vocabulary)
    for batch in batches:
        done = 0
        for texts in parts(batch.column(1)):
            words = words_of(texts, _GAP)
            term = find(words.hash)
            known = term >= 0
            key, count = np.unique(words.row[known] * size + term[known], return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(texts.rows + 1) * size).astype(np.int32))
            yield pa.record_batch(
                [
                    batch.column(0).slice(done, texts.rows),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array((key % size).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
                ],
                names=POSTINGS.fieldNames(),
            )
            done += texts.rows


def _frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each term."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(pc.list_flatten(batch.column(0)).to_numpy(), minlength=size)
    term = np.flatnonzero(total)
    yield pa.record_batch([pa.array(term), pa.array(total[term])], names=["term", "df"])


@dataclass
class Tile:
    """Items ``first`` on, the vocabulary of the tile, and its pairs in local numbers."""

    first: int
    size: int
    terms: np.ndarray
    item: np.ndarray
    term: np.ndarray

    def weights(self, weight: np.ndarray) -> np.ndarray:
        dense = np.zeros((self.size, len(self.terms)))
        dense[self.item, self.term] = weight[self.terms[self.term]]
        return dense


def tiles_of(items: Items, weight: np.ndarray, most_items: int = TILE_ITEMS, cells: int = TILE_CELLS) -> list[Tile]:
    """Consecutive items whose weights, over the terms they have, fit a tile; worthless terms are left out."""
    of, term = items.item[weight[items.term] > 0], items.term[weight[items.term] > 0]
    limits = np.searchsorted(of, np.arange(len(items.ids) + 1))
    made, first, seen = [], 0, set()

    def close(to: int) -> None:
        a, b = limits[first], limits[to]
        terms, local = np.unique(term[a:b], return_inverse=True)
        if len(terms):
            made.append(Tile(first, to - first, terms, of[a:b] - first, local))

    for i in range(len(items.ids)):
        own = set(term[limits[i] : limits[i + 1]].tolist())
        if i > first and (i - first >= most_items or (i - first + 1) * len(seen | own) > cells):
            close(i)
            first, seen = i, set()
        seen |= own
    if items.ids:
        close(len(items.ids))
    return made


class Top:
    """The best documents of a tile's items so far, with all that tie the last place until ids decide."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(items, np.int64)
        self.item = np.zeros(0, np.int64)
        self.score, self.doc, self.missing = self.item, self.item, np.zeros(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        """Scores of all items against a tile of documents."""
        least = self.least
        if scores.shape[1] > self.k:
            last = scores.shape[1] - self.k
            least = np.maximum(least, np.partition(scores, last, axis=1)[:, last])
        item, column = np.nonzero(scores >= least[:, None])
        if not len(item):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item) :], column]])
        ids = np.concatenate([self.doc, doc[column]])
        gone = np.concatenate([self.missing, missing[column]])
        order = np.lexsort([ids, gone, -score, item])
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[rank < self.k]
        self.least[item[rank == self.k - 1]] = score[order[rank == self.k - 1]]
        self.item, self.score, self.doc, self.missing = item[rank < self.k], score[keep], ids[keep], gone[keep]


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int, share: int) -> np.ndarray:
    """Whole-number impacts of term counts in documents of these lengths."""
    different, which = np.unique(lengths, return_inverse=True)
    # products of lengths and counts of documents may pass 2^63
    m = np.array([100 - share + share * int(n) * documents // total for n in different], np.int64)[which]
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def _search(batches: Iterator[pa.RecordBatch], items: Items, tiles: list[Tile], weight: np.ndarray,
            documents: int, total: int, k: int, share: int) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for every item of the pass."""
    best = [Top(t.size, k) for t in tiles]
    width = max(1, EXACT // (IMPACT * max(int(weight.max(initial=0)), 1)))
    for batch in batches:
        doc = batch.column(0).fill_null(0).to_numpy()
        missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(batch.column(2)).to_numpy()
        first = np.concatenate([[0], np.cumsum(sizes)])
        term = pc.list_flatten(batch.column(2)).to_numpy()
        count = pc.list_flatten(batch.column(3)).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        value = impacts(count, batch.column(1).to_numpy()[row], documents, total, share)
        for tile, top in zip(tiles, best, strict=True):
            local = np.full(len(weight), -1, np.int32)
            local[tile.terms] = np.arange(len(tile.terms), dtype=np.int32)
            dense = tile.weights(weight)
            docs = max(1, min(TILE_DOCS, TILE_CELLS // max(len(tile.terms), tile.size)))
            for a in range(0, len(doc), docs):
                b = min(a + docs, len(doc))
                at = local[term[first[a] : first[b]]]
                held = at >= 0
                block = np.zeros((len(tile.terms), b - a))
                block[at[held], row[first[a] : first[b]][held] - a] = value[first[a] : first[b]][held]
                scores = np.zeros((tile.size, b - a), np.int64)
                for low in range(0, len(tile.terms), width):
                    scores += (dense[:, low : low + width] @ block[low : low + width]).astype(np.int64)
                top.add(scores, doc[a:b], missing[a:b])
    for tile, top in zip(tiles, best, strict=True):
        ids = pa.array(items.ids, pa.int64()).take(pa.array(top.item + tile.first))
        yield pa.record_batch(
            [ids, pa.array(top.doc, pa.int64(), mask=top.missing), pa.array(top.score)], names=FOUND.fieldNames()
        )


def _best(found: DataFrame, k: int, *keys) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    share: int = LENGTH_SHARE,
    pass_items: int = PASS_ITEMS,
    pass_pairs: int = PASS_PAIRS,
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score`` above 0."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    pairs = settle(
        items.select(F.col("item_id").cast("long"), "text").mapInArrow(_item_terms, "item_id long, term long").distinct(),
        "item_terms",
    )
    found = spark.createDataFrame([], FOUND)
    for one in _passes(pairs, pass_items, pass_pairs):
        vocabulary = spark.sparkContext.broadcast(one.vocabulary)
        postings = settle(
            texts.mapInArrow(lambda b, v=vocabulary: _postings(b, v.value), POSTINGS), "postings"
        )
        n = F.col("n")
        documents, total = postings.agg(F.count_if(n > 0), F.sum(n)).first()
        if not total:
            break
        size = len(one.vocabulary)
        counted = (
            postings.select("terms")
            .mapInArrow(lambda b, s=size: _frequencies(b, s), "term long, df long")
            .groupBy("term")
            .agg(F.sum("df").alias("df"))
        )
        weight = np.zeros(size, np.int64)
        for term, df in counted.collect():  # the vocabulary of a pass at most
            weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        model = spark.sparkContext.broadcast((one, tiles_of(one, weight), weight, documents, total, k, share))
        found = found.unionByName(postings.mapInArrow(lambda b, m=model: _search(b, *m.value), FOUND))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    first = _best(found.withColumn("salt", salt), k, "item_id", "salt").drop("rank", "salt")
    return _best(first, k, "item_id").select(*RANKED.fieldNames())
