"""Language-model scores: Katz backoff over word pairs, counted on the whole corpus.

The score of a text is the sum over its tokens (words, then one end token) of
log10 P(token | token before).  A pair seen in training has its Good-Turing
discounted relative frequency; an unseen pair backs off to the word's own
discounted frequency times a weight that makes each history's probabilities sum
to one exactly; an unseen word has the mass that discounting words left over.
An unseen history uses the word's frequency alone.

Two exchanges carry the work.  The first deals pairs out by word, where all
training counts of a word and of its pairs meet; the second deals statistics of
histories out by history, where backoff weights are formed, and partial sums
back to the documents.  What depends on counts of counts is kept as small
histograms per text, so one pass suffices.  Tasks exchange packed arrays of
distinct pairs per block of about ``BLOCK_TOKENS`` tokens.  Hot words are dealt
out by pair, hot pairs are counted beforehand and scored where they stand, so
no word or pair gathers in one task.

Null and empty texts are one end token; long texts are scored whole; repeated
rows count as often as they occur and score alike; rows without an id train and
score like others; an empty table gives an empty table.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.labelled import held_out
from strata.llm.words import bounded_batches, mix, parts, release, words_of
from strata.session import settle

END, START = np.uint64(1), np.uint64(2)
BLOCK_TOKENS = 1_000_000
#: Counts up to this one are discounted by Good-Turing.
K = 5
#: What higher counts give up, so that every history keeps mass for unseen words.
DELTA = 0.01
#: A word or pair is hot above this part of a task's even share.
HOT_SHARE = 1 / 8


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays, whole numbers in as few bytes as they need, compressed."""
    small = [
        a.astype(np.min_scalar_type(int(a.max()))) if a.dtype == np.int64 and len(a) and a.min() >= 0 else a
        for a in arrays
    ]
    raw = pickle.dumps(small, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    return pickle.loads(raw)


@dataclass
class Block:
    """Tokens of some texts: each with the token before and its text's number."""

    ids: list
    train: np.ndarray
    sizes: np.ndarray
    token: np.ndarray
    before: np.ndarray
    text: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    held: list[tuple] = []
    tokens = 0

    def joined() -> Block:
        sizes = np.concatenate([h[2] for h in held])
        return Block(
            [k for h in held for k in h[0]],
            np.concatenate([h[1] for h in held]),
            sizes,
            np.concatenate([h[3] for h in held]),
            np.concatenate([h[4] for h in held]),
            np.repeat(np.arange(len(sizes)), sizes),
        )

    for batch in batches:
        ids = batch.column(0).to_pylist()
        train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        done = 0
        for texts in parts(batch.column(2)):
            words = words_of(texts)
            rows = texts.rows
            token = np.full(len(words.hash) + rows, END)
            token[np.arange(len(words.hash)) + words.row] = words.hash
            sizes = np.diff(words.first) + 1
            before = np.empty_like(token)
            before[1:] = token[:-1]
            before[np.cumsum(sizes) - sizes] = START
            held.append((ids[done : done + rows], train[done : done + rows], sizes, token, before))
            done += rows
            tokens += len(token)
            if tokens >= BLOCK_TOKENS:
                yield joined()
                held, tokens = [], 0
    if held:
        yield joined()


def _pair(token: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(token ^ (before << np.uint64(31) | before >> np.uint64(33)))


@dataclass
class Hot:
    """Frequent words and pairs with their training counts; keys sorted."""

    words: np.ndarray
    word_counts: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of known keys, -1 for others."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], -1)


def _find_hot(rows: DataFrame, n_parts: int) -> Hot:
    """Words and pairs above the hot share, with exact training counts.

    Whatever reaches the share overall reaches it in some block, so counting
    within blocks misses none; at most ``8 / HOT_SHARE * n_parts`` are kept of
    either kind, by frequency (the rest are then dealt out as usual).
    """
    share, most = HOT_SHARE / n_parts, int(8 / HOT_SHARE * n_parts)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for kind, values in ((0, block.token), (1, _pair(block.token, block.before))):
                key, count = np.unique(values, return_counts=True)
                keep = count >= max(share * len(values), 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(keep.sum(), kind)), pa.array(key[keep].view(np.int64)), pa.array(count[keep])],
                    names=["kind", "key", "n"],
                )

    found = (
        rows.mapInArrow(frequent, "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    )
    top = settle(found, "katz_hot")
    keys = [
        np.sort(
            top.where(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(most).toPandas()["key"].to_numpy(np.int64).view(np.uint64)
        )
        for kind in (0, 1)
    ]

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(len(k), np.int64) for k in keys]
        for block in _blocks(batches):
            seen = block.train[block.text]
            for total, wanted, values in zip(
                totals, keys, (block.token[seen], _pair(block.token, block.before)[seen]), strict=True
            ):
                at = _lookup(wanted, np.arange(len(wanted)), values)
                total += np.bincount(at[at >= 0], minlength=len(wanted))
        for kind, (total, wanted) in enumerate(zip(totals, keys, strict=True)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(wanted), kind)), pa.array(wanted.view(np.int64)), pa.array(total)],
                names=["kind", "key", "n"],
            )

    counted = rows.mapInArrow(exact, "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    got = counted.toPandas()  # no more rows than keys
    out = []
    for kind in (0, 1):
        part = got[got["kind"] == kind]
        key = part["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(key)
        out += [key[order], part["n"].to_numpy(np.int64)[order]]
    return Hot(*out)


#: Partial sums of a text: log terms, base terms, known tokens, pairs by count,
#: unseen pairs whose word has a low count, all unseen pairs with a known word, unknown words.
_SUMS = 3 + K + K + 2


def _sums(c: np.ndarray, w: np.ndarray, n: np.ndarray, end: np.ndarray, text: np.ndarray, rows: int) -> np.ndarray:
    """Partial sums per text, from pair count, word count and multiplicity of each entry."""
    known, seen = w > 0, c > 0
    out = np.zeros((_SUMS, rows))

    def add(i: int, where: np.ndarray, value: np.ndarray | float) -> None:
        out[i] += np.bincount(text[where], (n * value)[where] if np.ndim(value) else n[where] * value, rows)

    logs = np.zeros(len(n))
    logs[seen] = np.log10(np.where(c[seen] > K, c[seen] - DELTA, c[seen]))
    back = known & ~seen
    logs[back] = np.log10(np.where(w[back] > K, w[back] - DELTA, w[back]))
    # every word is the history of one more token
    logs -= np.where(known & ~end, np.log10(np.maximum(w, 1)), 0)
    add(0, np.ones(len(n), bool), logs)
    add(1, np.ones(len(n), bool), np.log10(w + 0.5))
    add(2, known, 1)
    for r in range(1, K + 1):
        add(2 + r, c == r, 1)
        add(2 + K + r, back & (w == r), 1)
    add(3 + 2 * K, back, 1)
    add(4 + 2 * K, ~known, 1)
    return out


def _packed_sums(out: np.ndarray) -> list[np.ndarray]:
    return [out[0], out[1], *(x.astype(np.int64) for x in out[2:])]


def _deal_pairs(hot: Hot, n_parts: int):
    """Per block: its texts' own facts, and distinct pairs with their texts by part."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            # the task's input decides the block, so a repeated task gives the same name
            name = int(mix(np.array([task * 1_000_003 + number], np.uint64)).view(np.int64)[0])
            rows = len(block.sizes)
            u, w, h, text, n = _distinct(block)
            pair = _pair(u[w], u[h])
            c = _lookup(hot.pairs, hot.pair_counts, pair)
            wc = _lookup(hot.words, hot.word_counts, u[w])
            here = (c > 0) & (wc > 0)
            own = _sums(c[here], wc[here], n[here], u[w[here]] == END, text[here], rows)
            facts = pickle.dumps((name, block.ids, block.train, block.sizes))
            yield _row("own", name % n_parts, facts, _pack(*_packed_sums(own)))
            part = np.where(wc >= 0, pair % np.uint64(n_parts), mix(u[w]) % np.uint64(n_parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            limits = np.searchsorted(part[order], np.arange(n_parts + 1))
            for p in np.flatnonzero(np.diff(limits)):
                i = order[limits[p] : limits[p + 1]]
                first = np.ones(len(i), bool)
                first[1:] = (w[i][1:] != w[i][:-1]) | (h[i][1:] != h[i][:-1])
                group = np.cumsum(first) - 1
                train = np.bincount(group, np.where(block.train[text[i]], n[i], 0)).astype(np.int64)
                wd, wi = np.unique(w[i][first], return_inverse=True)
                hd, hi = np.unique(h[i][first], return_inverse=True)
                refer = ~here[i]
                refs = np.bincount(group[refer], minlength=len(train))
                body = _pack(u[wd], wi, u[hd], hi, train, refs, text[i][refer], n[i][refer], np.array([rows]))
                yield _row("pairs", int(p), name.to_bytes(8, "little", signed=True), body)

    return deal


def _distinct(block: Block) -> tuple[np.ndarray, ...]:
    """Distinct hashes; then word, history, text and multiplicity of each distinct entry."""
    u, code = np.unique(np.append(block.token, START), return_inverse=True)
    w = code[:-1]
    h = np.empty_like(w)
    h[1:] = w[:-1]
    h[np.cumsum(block.sizes) - block.sizes] = code[-1]
    rows = len(block.sizes)
    if len(u) ** 2 * rows < 2**62:
        entry, n = np.unique((w * len(u) + h) * rows + block.text, return_counts=True)
        pair, text = np.divmod(entry, rows)
        w, h = np.divmod(pair, len(u))
        return u, w, h, text, n
    order = np.lexsort((block.text, h, w))
    w, h, text = w[order], h[order], block.text[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return u, w[at], h[at], text[at], np.diff(np.append(at, len(w)))


_ROW = "kind string, part long, head binary, body binary"


def _row(kind: str, part: int, head: bytes, body: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind]), pa.array([part], pa.int64()), pa.array([head], pa.binary()), pa.array([body], pa.binary())],
        names=["kind", "part", "head", "body"],
    )


def _meet_words(hot: Hot, n_parts: int):
    """All counts of a part's pairs: histories' statistics and the texts' partial sums."""

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(k, p, h, b) for k, p, h, b in rows[rows["kind"] == "own"].itertuples(index=False)]
        names, loaded = [], []
        for head, body in rows.loc[rows["kind"] == "pairs", ["head", "body"]].itertuples(index=False):
            names.append(int.from_bytes(head, "little", signed=True))
            loaded.append(_unpack(body))
        if not loaded:
            return pd.DataFrame(out, columns=["kind", "part", "head", "body"])
        word = np.concatenate([x[0][x[1]] for x in loaded])
        history = np.concatenate([x[2][x[3]] for x in loaded])
        train = np.concatenate([x[4] for x in loaded])
        # of each block only who refers to its pairs is needed from here on
        loaded = [(len(x[1]), *x[5:9]) for x in loaded]
        release()
        uw, wi = _numbered(word)
        uh, hi = _numbered(history)
        del word, history
        _, pi = _numbered(wi.astype(np.int64) * len(uh) + hi)
        c = np.bincount(pi, train).astype(np.int64)
        own_count = np.bincount(wi, train, len(uw)).astype(np.int64)
        known = _lookup(hot.words, hot.word_counts, uw)
        wc = np.where(known >= 0, known, own_count)

        # histories: pairs by count, then words after it by count
        del train
        one = np.zeros(len(c), np.int32)
        one[pi] = np.arange(len(pi), dtype=np.int32)
        pair_h, pair_w = hi[one], wc[wi[one]]
        seen = c > 0
        stats = [np.bincount(pair_h[seen], c[seen], len(uh))]
        for values in (c, pair_w):
            for r in range(1, K + 1):
                stats.append(np.bincount(pair_h[seen & (values == r)], minlength=len(uh)))
            stats.append(np.bincount(pair_h[seen & (values > K)], minlength=len(uh)))
        high = seen & (pair_w > K)
        stats.append(np.bincount(pair_h[high], pair_w[high], len(uh)))
        stats = np.column_stack(stats).astype(np.int64)
        kept = np.flatnonzero(stats[:, 0])
        # hot histories, and the one of first words, need not meet: their rows are few
        is_hot = (_lookup(hot.words, hot.word_counts, uh) >= 0) | (uh == START)
        home = (mix(uh) % np.uint64(n_parts)).astype(np.int64)
        for q, some in _by_part(home, kept[~is_hot[kept]]):
            out.append(("history", q, b"", _pack(uh[some], *stats[some].T)))
        warm, rest = kept[is_hot[kept]], known < 0
        n_pair = np.bincount(np.minimum(c, K + 2), minlength=K + 3)
        n_word = np.bincount(np.minimum(wc[rest], K + 2), minlength=K + 3)
        facts = (n_pair, n_word, int(wc[rest].sum()), int((wc[rest] > 0).sum()), uh[warm], stats[warm])
        out.append(("counts", 0, b"", pickle.dumps(facts)))

        asking: list[tuple[np.ndarray, ...]] = []
        sizes, at = np.zeros(len(names), np.int64), 0
        for number, (pairs, refs, of_text, times, rows_of_block) in enumerate(loaded):
            entry = np.repeat(np.arange(at, at + pairs), refs.astype(np.int64))
            at += pairs
            text, n, sizes[number] = of_text.astype(np.int64), times.astype(np.int64), int(rows_of_block[0])
            cc, ww = c[pi[entry]], wc[wi[entry]]
            sums = _sums(cc, ww, n, uw[wi[entry]] == END, text, int(sizes[number]))
            name = names[number]
            body = _pack(*_packed_sums(sums))
            out.append(("sums", name % n_parts, name.to_bytes(8, "little", signed=True), body))
            ask = np.flatnonzero(cc == 0)
            h = hi[entry[ask]]
            # a hot history's weight is known everywhere, so its texts need not meet there
            to = np.where(is_hot[h], name % n_parts, home[h])
            asking.append((to, np.full(len(ask), number), h, text[ask], n[ask]))
        to, number, h, text, n = (np.concatenate(x) for x in zip(*asking, strict=True))
        for q, i in _by_part(to, np.arange(len(to))):
            dictionary, code = np.unique(h[i], return_inverse=True)
            used, which = np.unique(number[i], return_inverse=True)
            body = _pack(uh[dictionary], code, np.array(names)[used], sizes[used], which, text[i], n[i])
            out.append(("asks", q, b"", body))
        del asking, to, number, h, text, n, loaded
        release()
        return pd.DataFrame(out, columns=["kind", "part", "head", "body"])

    return meet


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and each value's number among them, in four bytes."""
    distinct, number = np.unique(values, return_inverse=True)
    return distinct, number.astype(np.int32)


def _by_part(part: np.ndarray, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The chosen positions by their part."""
    order = chosen[np.argsort(part[chosen], kind="stable")]
    ends = np.flatnonzero(np.append(np.diff(part[order]) != 0, True)) + 1 if len(order) else []
    start = 0
    for end in ends:
        yield int(part[order[start]]), order[start:end]
        start = end


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing factors of counts 1 to K from counts of counts (Katz).

    A factor outside (0, 1), as on small corpora, is replaced by (r - 0.5) / r.
    """
    out = np.ones(K + 1)
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        factor = np.nan
        if n[r] and n[r + 1] and common < 1:
            factor = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        out[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return out


@dataclass
class Model:
    """What is global: discounts of pairs and words, token and word totals, hot weights."""

    pair: np.ndarray
    word: np.ndarray
    tokens: int
    distinct: int
    texts: int
    unknown: float
    hot: np.ndarray
    hot_weights: np.ndarray

    def weight(self, stats: np.ndarray) -> np.ndarray:
        """log10 of backoff weight times history count, from the history's statistics."""
        r = np.arange(1, K + 1)
        left = stats[:, 1 : K + 1] @ (r * (1 - self.pair[1:])) + DELTA * stats[:, K + 1]
        low = stats[:, K + 2 : 2 * K + 2] @ (r * self.word[1:])
        used = (low + stats[:, 2 * K + 3] - DELTA * stats[:, 2 * K + 2]) / self.tokens
        return np.log10(left / (1 - used))


def _answer(model: Model):
    """Backoff weights of a part's histories, added up for the texts that ask."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        keys, weights = model.hot, model.hot_weights
        tables = [_unpack(x) for x in rows.loc[rows["kind"] == "history", "body"]]
        if tables:
            u, at = _numbered(np.concatenate([x[0] for x in tables]))
            total = np.column_stack(
                [np.bincount(at, np.concatenate(column), len(u)) for column in zip(*(x[1:] for x in tables), strict=True)]
            )
            keys, weights = np.concatenate([keys, u]), np.concatenate([weights, model.weight(total)])
            order = np.argsort(keys)
            keys, weights = keys[order], weights[order]
        sums: dict[int, np.ndarray] = {}
        for body in rows.loc[rows["kind"] == "asks", "body"]:
            u, code, names, sizes, which, text, n = _unpack(body)
            value = np.zeros(len(u))  # an unseen history has no weight
            if len(keys):
                at = np.minimum(np.searchsorted(keys, u), len(keys) - 1)
                value = np.where(keys[at] == u, weights[at], 0.0)
            order = np.argsort(which, kind="stable")
            cuts = np.searchsorted(which[order], np.arange(len(names) + 1))
            for k, (name, size) in enumerate(zip(names, sizes, strict=True)):
                i = order[cuts[k] : cuts[k + 1]]
                part = np.bincount(text[i], n[i] * value[code[i]], int(size))
                sums[int(name)] = sums.get(int(name), 0) + part
        out = [
            ("weights", name, name.to_bytes(8, "little", signed=True), _pack(part)) for name, part in sums.items()
        ]
        return pd.DataFrame(out, columns=["kind", "part", "head", "body"])

    return answer


def _finish(model: Model):
    """Scores of the texts of each block."""
    log = np.log10
    with np.errstate(divide="ignore"):
        pair, word = log(model.pair[1:]), log(model.word[1:])
    rate = log(model.tokens + 0.5 * (model.distinct + 1))
    log_unknown = log(model.unknown) if model.unknown > 0 else 0.0
    log_tokens, log_texts = log(max(model.tokens, 1)), log(max(model.texts, 1))

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        frames = []
        rows = rows.assign(
            name=[
                pickle.loads(h)[0] if k == "own" else int.from_bytes(h, "little", signed=True)
                for k, h in zip(rows["kind"], rows["head"], strict=True)
            ]
        )
        for _, block in rows.groupby("name"):
            _, ids, train, sizes = pickle.loads(block.loc[block["kind"] == "own", "head"].iloc[0])
            total = np.zeros((_SUMS, len(ids)))
            for kind, body in zip(block["kind"], block["body"], strict=True):
                if kind == "weights":
                    total[0] += _unpack(body)[0]
                else:
                    total += np.array([x.astype(float) for x in _unpack(body)])
            score = total[0] - log_texts + pair @ total[3 : 3 + K] + word @ total[3 + K : 3 + 2 * K]
            score += -log_tokens * total[3 + 2 * K] + log_unknown * total[4 + 2 * K]
            frames.append(
                pd.DataFrame(
                    {
                        "id": ids, "held_out": ~train, "n_tokens": sizes, "n_known": total[2].astype(np.int64),
                        "train_tokens": model.tokens, "base_score": total[1] - rate * sizes, "score": score,
                    }
                )
            )
        return pd.concat(frames)

    return finish


def _global(met: DataFrame, hot: Hot) -> Model:
    """Totals over parts, from one row per part: histograms and the few hot histories."""
    n_pair, n_word = np.zeros(K + 3, np.int64), np.zeros(K + 3, np.int64)
    tokens, distinct = int(hot.word_counts.sum()), int((hot.word_counts > 0).sum())
    n_word += np.bincount(np.minimum(hot.word_counts, K + 2), minlength=K + 3)
    stats: dict[int, np.ndarray] = {}
    for (body,) in met.where("kind = 'counts'").select("body").toLocalIterator():
        a, b, c, d, keys, rows = pickle.loads(body)
        n_pair, n_word, tokens, distinct = n_pair + a, n_word + b, tokens + c, distinct + d
        for key, row in zip(keys, rows, strict=True):
            stats[int(key)] = stats.get(int(key), 0) + row
    word = discounts(n_word)
    left = sum(n_word[r] * r * (1 - word[r]) for r in range(1, K + 1))
    high = n_word[K + 1 :].sum()
    unknown = (left + DELTA * high) / tokens if tokens else 1.0
    texts = 0
    model = Model(discounts(n_pair), word, tokens, distinct, texts, unknown, np.zeros(0, np.uint64), np.zeros(0))
    if stats:
        model.hot = np.sort(np.array(list(stats), np.uint64))
        model.hot_weights = model.weight(np.array([stats[int(k)] for k in model.hot], float))
    return model


def katz_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, n_parts: int | None = None
) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from the rows whose crc32 of the id modulo ``folds`` is not 1.
    """
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    n_parts = n_parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    rows = docs.select(
        F.col(id_col).alias("id"), (~held_out(id_col, folds)).alias("train"), F.col(text_col).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    hot = _find_hot(rows, n_parts)
    met = settle(
        rows.mapInArrow(_deal_pairs(hot, n_parts), _ROW)
        .repartition(n_parts, "part")
        .groupBy("part")
        .applyInPandas(_meet_words(hot, n_parts), _ROW),
        "katz",
    )
    model = _global(met, hot)
    model.texts = rows.where("train").count()
    answered = (
        met.where("kind in ('history', 'asks')")
        .repartition(n_parts, "part")
        .groupBy("part")
        .applyInPandas(_answer(model), _ROW)
    )
    back = met.where("kind in ('own', 'sums')").unionByName(
        answered.withColumn("part", F.pmod("part", F.lit(n_parts)))
    )
    return (
        back.repartition(n_parts, "part")
        .groupBy("part")
        .applyInPandas(
            _finish(model),
            f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
        .withColumnRenamed("id", id_col)
    )
