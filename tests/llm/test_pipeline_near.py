"""The near_duplicates stage against its own brute force: five-word shingles, four fifths in common."""

from collections import Counter, defaultdict

import corpus_pipeline as P
from strata.llm.queries import table

BIG = "/root/testdata/sf0.01"


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def kept(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    having, parent = defaultdict(list), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, both in Counter(j for s in sets[i] for j in having[s]).items():
            if 100 * both >= 80 * len(sets[i] | sets[j]):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
        for s in sets[i]:
            having[s].append(i)
    return {i for i in sets if find(i) == i}


def test_stage_equals_brute_force(spark):
    docs = table(spark, BIG, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    want = kept(texts)
    got = [r["doc_id"] for r in P.near_duplicates(spark, docs, BIG).select("doc_id").collect()]
    assert sorted(got) == sorted(want) and len(want) < len(texts)
