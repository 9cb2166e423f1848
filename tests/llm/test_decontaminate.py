import re

import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate as D
from strata.llm.queries import op7_decontaminate, table

ITEM = "If Alice buys 5 kg of apples and Bob buys 7 kg of pears, how much does Alice carry in total?"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "short one here"), (3, None), (4, ""), (None, ITEM), (5, "12 13 14 15 16 17 18 19 20")]
    return spark.createDataFrame(rows, "item_id long, text string")


def pairs(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = D.contaminated_pairs(docs, items).collect()
    return {(r["doc_id"], r["item_id"]): (r["n_matched"], r["n_windows"], r["verbatim"]) for r in found}


def test_copies_and_new_parameters(spark, items):
    got = pairs(
        spark,
        items,
        [
            "Lead in. " + ITEM + " And on.",
            ITEM.upper() + " x",
            "So: If Carol buys 9 kg of apples and Dave buys 3 kg of pears, how much does Carol carry in total?",
            # the same template, but the slots do not agree
            "If Carol buys 9 kg of apples and Dave buys 3 kg of pears, how much does Dave carry in total?",
            "If Carol buys 9 kg of apples and Carol buys 3 kg of pears, how much does Carol carry in total?",
            "21 22 23 24 25 26 27 28 29 30",
            "a short  one\there b",
            ITEM.replace("apples", "plums").replace("much", "little"),
        ],
    )
    assert got[0, 1] == (14, 14, True) and got[2, 1] == (14, 14, False)
    assert got[6, 2] == (1, 1, True)
    assert set(got) == {(0, 1), (2, 1), (6, 2)}


def test_template(spark):
    frame = spark.createDataFrame([("The Ford car. Then 5 km, 3kg of É and Élan 4 % ok\nNew",)], "t string")
    (row,) = D._with_template(frame, "t").collect()
    assert row["_low"] == "the <name> car. then <num> <unit> <num> of é and <name> <num> <unit> ok\nnew"
    assert len(row["_low"].split()) == len(row["t"].split())


def test_windows_of_every_length(spark):
    words = [f"w{i % 5}" for i in range(20)]
    frame = spark.createDataFrame([(words,), (["a"],), ([],)], "words array<string>")
    for n in range(1, 9):
        long, one, none = (r["_windows"] for r in D._with_windows(frame, n).select("_windows").collect())
        assert len(long) == 21 - n and len(one) == (n == 1) and none == []
        texts = [tuple(words[i : i + n]) for i in range(21 - n)]
        assert len(set(long)) == len(set(texts))
        assert all((a == b) == (x == y) for a, x in zip(long, texts, strict=True) for b, y in zip(long, texts, strict=True))


def test_query_finds_all_passages(spark, sf_dir, documents):
    """Brute force: plain windows of eight words, enough of an item's."""

    def windows(text):
        w = re.sub(r"\s+", " ", (text or "").lower()).split()
        return [tuple(w[i : i + 8]) for i in range(len(w) - 7)]

    bench = {r["item_id"]: windows(r["text"]) for r in table(spark, sf_dir, "benchmark").collect()}
    want = set()
    for d in documents:
        mine = set(windows(d["text"]))
        want |= {(d["doc_id"], i) for i, w in bench.items() if len(mine & set(w)) >= max(3, 0.3 * len(w))}
    got = {(r["doc_id"], r["item_id"]) for r in op7_decontaminate(spark, sf_dir).collect()}
    assert got == want and want


def test_without_broadcast(spark, sf_dir, monkeypatch):
    a = {tuple(r) for r in op7_decontaminate(spark, sf_dir).collect()}
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert {tuple(r) for r in op7_decontaminate(spark, sf_dir).collect()} == a


def test_odd_rows(spark, items, odd_documents, no_documents):
    assert D.contaminated_pairs(odd_documents, items).count() == 0
    assert D.contaminated_pairs(no_documents, items).count() == 0
    assert D.contaminated_pairs(odd_documents, items.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, ITEM, 0, 0)] * 2 + [(None, ITEM, 0, 0)], "doc_id long, text string, item int, doc int")
    assert [r["doc_id"] for r in D.contaminated_pairs(twice, items).collect()] == [1]
    plan = D.contaminated_pairs(twice, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_white_space_of_any_kind_is_one_space(spark, items):
    other = "If Carol buys 9 kg of apples and Dave buys 3 kg of pears, how much does Carol carry in total?"
    texts = [other, other.replace(" ", "  "), other.replace(" ", "\t"), re.sub("(.{30}) ", "\\1\n", other), other.replace(" ", " \r\n ")]
    got = pairs(spark, items, texts)
    assert {k: v[:2] for k, v in got.items()} == {(i, 1): (14, 14) for i in range(5)}


def test_table_of_hashes_knows_its_own(spark):
    frame = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id")
    own = [r["h"] for r in frame.where("id < 5000").collect()]
    test = D._table_of(own)
    hits = frame.select("id", test(F.col("h")).alias("hit")).where("hit").collect()
    assert sum(r["id"] < 5000 for r in hits) == 5000 and len(hits) < 5000 + 30


def test_tables_of_item_windows_stand_in_the_plan_once_for_each_step(spark):
    """The driver writes the plan out again and again, so a table in each probe fills its memory."""
    item = "a farmer keeps 12 hens in 4 sheds and sells all their eggs each week"
    docs = spark.createDataFrame([(1, item), (2, "nothing of the kind is written in here today")], "doc_id LONG, text STRING")
    found = D.contaminated_pairs(docs, spark.createDataFrame([(7, item)], "item_id LONG, text STRING"))
    assert [tuple(r) for r in found.select("doc_id", "item_id").collect()] == [(1, 7)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    tables = re.findall(r"(?:-?[0-9]+, *){63,}-?[0-9]+", plan)
    assert len(tables) == 3  # beginnings of texts and of their own words, and windows of both
