import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import katz as K
from strata.llm.queries import op10_katz


def tokens(text):
    return [w.decode("utf-8", "surrogateescape") for w in (text or "").encode().lower().split()] + ["</s>"]


class Brute:
    """The same model from plain counters."""

    def __init__(self, rows, folds=5):
        self.held = [i is not None and zlib.crc32(str(i).encode()) % folds == 1 for i, _ in rows]
        self.one, self.two = Counter(), Counter()
        for (_, text), held in zip(rows, self.held, strict=True):
            if not held:
                t = tokens(text)
                self.one.update(t)
                self.two.update(zip(["<s>", *t], t, strict=False))
        self.n = sum(self.one.values())
        hist = [np.zeros(K.K + 3, int), np.zeros(K.K + 3, int)]
        for h, c in zip(hist, (self.one, self.two), strict=True):
            for v in c.values():
                h[min(v, K.K + 2)] += 1
        self.d1, self.d2 = K.discounts(hist[0]), K.discounts(hist[1])
        self.after = defaultdict(dict)
        for (h, w), c in self.two.items():
            self.after[h][w] = c
        self.total = {h: sum(x.values()) for h, x in self.after.items()}
        self.unknown = sum(c - self.kept(c, self.d1) for c in self.one.values()) / self.n if self.n else 1.0

    @staticmethod
    def kept(c, d):
        return d[c] * c if c <= K.K else c - K.DELTA

    def word(self, w):
        return self.kept(self.one[w], self.d1) / self.n if self.one[w] else self.unknown

    def weight(self, h):
        used = sum(self.kept(c, self.d2) for c in self.after[h].values()) / self.total[h]
        return (1 - used) / (1 - sum(self.word(w) for w in self.after[h]))

    def chance(self, h, w):
        if h not in self.total:
            return self.word(w)
        c = self.after[h].get(w, 0)
        return self.kept(c, self.d2) / self.total[h] if c else self.weight(h) * self.word(w)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.chance(h, w)) for h, w in zip(["<s>", *t], t, strict=False))

    def base(self, text):
        return sum(math.log10((self.one[w] + 0.5) / (self.n + 0.5 * (len(self.one) + 1))) for w in tokens(text))


def compare(rows, found):
    model = Brute(rows)
    want = sorted(
        (str(i), h, len(tokens(t)), sum(model.one[w] > 0 for w in tokens(t)), model.n, model.base(t), model.score(t))
        for (i, t), h in zip(rows, model.held, strict=True)
    )
    got = sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
        for r in found.collect()
    )
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-4)
    return model


def test_query_equals_brute_force(spark, sf_dir, documents):
    model = compare([(r["doc_id"], r["text"]) for r in documents], op10_katz(spark, sf_dir))
    for h in [*list(model.total)[:40], "never seen"]:  # each history's probabilities sum to one
        assert sum(model.chance(h, w) for w in model.one) + model.chance(h, "unheard of") == pytest.approx(1)


def test_small_blocks_and_many_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_TOKENS", 900)
    rows = [(r["doc_id"], r["text"]) for r in documents[:60]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    compare(rows, K.katz_scores(frame, n_parts=23))
    monkeypatch.setattr(K, "HOT_SHARE", 1e-3)
    compare(rows, K.katz_scores(frame, n_parts=3))


def test_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    compare(rows, K.katz_scores(odd_documents))
    assert K.katz_scores(no_documents).count() == 0


def test_discounts():
    n = np.array([0, 100, 40, 20, 12, 8, 5, 50])
    d = K.discounts(n)
    for r in range(1, K.K + 1):
        star = (r + 1) * n[r + 1] / n[r]
        common = (K.K + 1) * n[K.K + 1] / n[1]
        assert d[r] == pytest.approx((star / r - common) / (1 - common))
    assert (K.discounts(np.zeros(8, int))[1:] == [(r - 0.5) / r for r in range(1, 6)]).all()
