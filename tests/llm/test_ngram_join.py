import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import ngram_join as N
from strata.llm.components import connected_components
from strata.llm.queries import op3_ngram_join


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def brute(texts):
    """component and set size by id; every pair is compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"w{rng.randrange(10**6)}" for w in words)


@pytest.fixture(scope="module")
def near_copies():
    """Groups of near copies about the threshold, shared passages, copies, short texts."""
    rng = random.Random(11)
    texts, passage = [], [f"p{k}" for k in range(60)]
    for group in range(6):
        base = [f"g{group}_{rng.randrange(400)}" for _ in range(80 + 60 * group)]
        texts += [edited(rng, base, s) for s in (0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.04) for _ in range(6)]
    for k in range(40):
        own = [f"o{k}_{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90))]
        texts.append(" ".join(own + passage[: rng.randrange(20, 60)]))
    texts += ["a b c", "A  B c", "a b c d", "a b c d e", "", "x"] + [texts[0]] * 5 + [texts[50].upper()]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def frame_of(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)


def test_equals_brute_force(spark, near_copies):
    assert got(N.ngram_components(frame_of(spark, near_copies))) == brute(near_copies)


def test_frequent_shingles_and_small_blocks(spark, near_copies, monkeypatch):
    monkeypatch.setattr(N, "HOT_SETS", 4)
    monkeypatch.setattr(N, "BLOCK_SETS", 5)
    monkeypatch.setattr(N, "SALTS", 3)
    monkeypatch.setattr(N, "FILTER_BITS", 64)
    one_task = frame_of(spark, near_copies).coalesce(1)
    assert got(N.ngram_components(one_task)) == brute(near_copies)


def test_query_equals_brute_force(spark, sf_dir, documents):
    assert got(op3_ngram_join(spark, sf_dir)) == brute({r["doc_id"]: r["text"] for r in documents})


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(200):
        both = rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64)
        x, y = (np.unique(np.append(both, rng.integers(0, 2**63, rng.integers(0, 400)).astype(np.uint64))) for _ in range(2))
        bound = N.overlap_bound(N._bits(x), N._bits(y), len(x), len(y))
        assert len(np.intersect1d(x, y)) <= bound <= min(len(x), len(y))


def test_odd_rows(spark, odd_documents, no_documents):
    rows = N.ngram_components(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["component_id"] == by_id[6]["component_id"] == 1
    assert [by_id[i]["n_shingles"] for i in (2, 3, 4, 7, 8)] == [0, 0, 0, 1, 1]
    assert all(by_id[i]["component_id"] == i for i in (2, 3, 4, 5, 7, 8, 9))
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert N.ngram_components(no_documents).count() == 0
    kept = N.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert ids == [1, 2, 3, 4, 5, 7, 8, 9] and kept.where("doc_id is null").count() == 2


def test_components(spark):
    chain = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 1400).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    odd = spark.createDataFrame([(5, 5), (None, 3), (3, None), (2000, 2001), (2001, 2000)], "a long, b long")
    found = {r["id"]: r["component"] for r in connected_components(chain.union(star).union(odd)).collect()}
    want = {i: 0 for i in range(61)} | {i: 999 for i in range(999, 1400)} | {2000: 2000, 2001: 2000}
    assert found == want
    assert connected_components(odd.limit(0)).count() == 0


def test_rows_that_share_an_id_are_decided_by_their_own_texts(spark):
    words = [f"w{i}" for i in range(40)]
    copied, other = " ".join(words), " ".join(reversed(words))
    rows = [(0, copied), (1, copied), (1, other), (1, other), (2, other), (3, "short"), (3, None), (3, ""), (None, copied)]
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((tuple(r) for r in kept.collect()), key=repr)
    assert got in (
        sorted([(0, copied), (1, other), (3, "short"), (3, None), (None, copied)], key=repr),
        sorted([(0, copied), (1, other), (3, "short"), (3, ""), (None, copied)], key=repr),
    )
