import hashlib
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import pii
from strata.llm.queries import op5_pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def valid(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in BASE.items()
        for m in pattern.finditer(text or "")
        if valid(kind, m[0])
    ]


ODD = [
    "a@b@c.de x@y.com_z@w.org +a@-.b.c é@x.y", "1.2.3 1..2.3.4.5 1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.01 1.2.3.999",
    "4111 1111 1111 1111 4111-1111-1111-1112 411111111111111 12--34 0000000000000 4111111111111111111111",
    "+1 (017) 555-5036 + 1 555 +12 ++1-2-3-4-5-6-7-8-9) +1234567890123456 +49.30.1234567.", "日本 a.b@c.de 日 10.0.0.1",
    "x" * 3000 + "@" + "y" * 3000 + ".z " + "1" * 5000 + " " + "1.2.3." * 2000, "@ @@ a@ @b.c", "", None, "no digits",
]


def test_base_kinds_equal_plain_patterns(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = {r["doc_id"]: r["pii_spans"] for r in pii.find_personal_data(docs).collect()}
    for i, text in enumerate(ODD):
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in rows[i] if s["kind"] != "context"] == base_spans(text)


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = {r["doc_id"]: r for r in op5_pii(spark, sf_dir).collect()}
    assert len(rows) == len(documents)
    for d in documents:
        want = base_spans(d["text"])
        row = rows[d["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in BASE:
            assert row[f"n_{kind}"] == sum(s.startswith(kind) for s in want)


@pytest.fixture(scope="module")
def contexts(spark):
    rows = [(i, f"please call my number +1 555 010 {1000 + i} today") for i in range(40)]
    rows += [(100 + i, f"some text, my number 0555-77{i:02d} today ok") for i in range(5)]
    rows += [(200 + i, f"the order 9900{i} was sent in year 20{i:02d}") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_contexts_of_seeds_discover_unseen_identifiers(contexts):
    found = {r["doc_id"]: r["pii_spans"] for r in pii.find_personal_data(contexts).collect()}
    for i in range(40):
        assert [s["kind"] for s in found[i]] == ["phone"]
    for i in range(5):
        (span,) = found[100 + i]
        assert (span["kind"], span["start"], span["end"]) == ("context", 21, 30)
    assert not any(found[200 + i] for i in range(20))


def test_scores_equal_a_plain_loop(spark):
    edges = [("p", f"v{i}", i < 3) for i in range(4)] + [("q", f"v{i}", i < 3) for i in (2, 3, 4, 5)] + [("r", "v9", False)]
    frame = spark.createDataFrame(edges, "pattern string, value string, seed boolean")
    patterns, values = pii.score_graph(frame, rounds=2, support=1, least=0.3)
    believed = {v: float(s) for _, v, s in edges}
    for _ in range(2):
        score = {}
        for p in "pqr":
            mine = [believed[v] for q, v, _ in edges if q == p]
            if sum(mine) >= 1 and sum(mine) / len(mine) >= 0.3:
                score[p] = sum(mine) / len(mine)
        believed = {
            v: max([float(s) for _, w, s in edges if w == v] + [score.get(p, 0.0) for p, w, _ in edges if w == v])
            for _, v, _ in edges
        }
    assert {r["pattern"]: r["score"] for r in patterns.collect()} == pytest.approx(score)
    assert {r["value"]: r["believed"] for r in values.collect()} == pytest.approx(believed)


def test_plan_has_no_python(contexts):
    plan = pii.find_personal_data(contexts)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd_documents, no_documents):
    rows = pii.find_personal_data(odd_documents.withColumn("uid", F.lit(1))).collect()
    assert len(rows) == odd_documents.count() and all(r["pii_spans"] is not None for r in rows)
    assert pii.find_personal_data(no_documents).count() == 0
