import math
import random
import re

import numpy as np
import pytest

from strata.llm.oracles import ORACLES
from strata.llm.queries import op11_ranked_search
from strata.llm.ranked_search import RANKED, Items, Top, _positions, impacts, ranked_search, tiles_of
from tests.oracle import differences, duck

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, score long, item_id string, terms string"
ITEMS = "item_id long, text string, doc_id string"


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute_force(docs, items, k=10):
    words = [(d, terms(t)) for d, t in docs]
    n = sum(bool(w) for _, w in words)
    total = sum(len(w) for _, w in words)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in wanted.items():
        df = {t: sum(t in set(w) for _, w in words) for t in query}
        found = []
        for d, w in words:
            score = 0
            for t in query & set(w):
                tf, m = w.count(t), 10 + 90 * len(w) * n // total
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=repr)


def ranked(spark, docs, items, **more):
    got = ranked_search(
        spark.createDataFrame([(*d, 1, "x", "y") for d in docs], DOCS),
        spark.createDataFrame([(*i, "z") for i in items], ITEMS),
        **more,
    )
    assert got.schema.fieldNames() == RANKED.fieldNames()
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_query_equals_oracle(spark, sf_dir):
    assert differences(op11_ranked_search, ORACLES["op11_ranked_search"], spark, duck(sf_dir), sf_dir) == []


@pytest.mark.parametrize("limits", [{}, {"pass_items": 3}, {"pass_pairs": 8}])
def test_ties_copies_and_passes(spark, limits):
    r = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "delta7", "naïve", "日本", "x"]
    docs = [(i, " ".join(r.choices(words, k=r.randrange(1, 9)))) for i in range(120)]
    docs += [(1000 - i, "alpha BETA!") for i in range(60)] + [(7, "alpha beta")] * 15
    items = [(i, "-".join(r.choices(words, k=r.randrange(1, 5)))) for i in range(9)] + [(4, "alpha"), (50, "unknown")]
    assert ranked(spark, docs, items, **limits) == brute_force(docs, items)


def test_odd_rows(spark):
    long_text = "lorem ipsum " * 100_000 + "end"
    docs = [(1, None), (2, ""), (3, " \n.,"), (4, long_text), (None, "end of it"), (None, "end of it"), (5, "END of it"),
            (6, "x" * 100_000), (-7, "ÄÖ äö ÄÖ"), (8, "a\x00b_c")]
    items = [(1, "end"), (2, None), (3, "..."), (None, "of it"), (4, "ÄÖ"), (5, "b c a"), (1, "x" * 100_000)]
    got = ranked(spark, docs, items)
    assert got == brute_force(docs, items)
    assert [r[2] for r in got if r[0] is None] == [5, None, None]


def test_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, [(1, "a")], []) == []
    assert ranked(spark, [(1, None)], [(1, "a")]) == []


def test_top_keeps_ties_until_ids_decide():
    r = np.random.default_rng(0)
    scores = r.integers(0, 4, (5, 300))
    ids = r.permutation(300)
    top = Top(5, 10)
    for a in range(0, 300, 37):
        top.add(scores[:, a : a + 37], ids[a : a + 37], np.zeros(len(ids[a : a + 37]), bool))
    for item in range(5):
        want = sorted((-s, d) for s, d in zip(scores[item], ids, strict=True) if s > 0)[:10]
        assert [(-s, d) for i, s, d in zip(top.item, top.score, top.doc, strict=True) if i == item] == want


def test_tiles_fit_and_hold_every_pair():
    r = np.random.default_rng(1)
    term = np.concatenate([np.sort(r.choice(500, 20, replace=False)) for _ in range(40)])
    items = Items(list(range(40)), np.arange(500, dtype=np.uint64), np.repeat(np.arange(40), 20), term)
    weight = np.full(500, 7)
    tiles = tiles_of(items, weight, 16, 1_000)
    assert all(t.size <= 16 and (t.size == 1 or t.size * len(t.terms) <= 1_000) for t in tiles)
    assert sum(t.size for t in tiles) == 40
    dense = np.zeros((40, 500))
    for t in tiles:
        dense[t.first : t.first + t.size, t.terms] = t.weights(weight)
    assert dense.sum() == 7 * 800 and (dense[items.item, items.term] == 7).all()


def test_largest_values():
    assert impacts(np.array([10**9]), np.array([10**7]), 10**13, 10**16, 90).dtype == np.int64
    assert int(impacts(np.array([10**9]), np.array([1]), 1, 1, 90)[0]) < 1_000_000
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2))
    find = _positions(keys)
    assert (find(keys) == np.arange(len(keys))).all() and (find(keys + np.uint64(1)) == -1).all()
