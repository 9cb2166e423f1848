import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import labelled, quality, toxicity
from strata.llm.queries import op2_quality, op8_toxicity, table

BIG = "/root/testdata/sf0.01"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.mark.parametrize(
    ("query", "label", "threshold", "accuracy"),
    [(op2_quality, "quality", 0.5, 0.97), (op8_toxicity, "toxic", 0.7, 0.93)],
)
def test_held_out_accuracy_and_columns(spark, query, label, threshold, accuracy):
    rows = query(spark, BIG).collect()
    assert len(rows) == table(spark, BIG, "documents").count()
    for r in rows:
        assert r["held_out"] == held(r["doc_id"])
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    truth = {r["doc_id"]: r[label] for r in table(spark, BIG, "labels").collect()}
    told = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(told) > 50 and np.mean(told) >= accuracy


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    turned = labels.withColumn(
        "toxic", F.when(labelled.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a = toxicity.score_toxicity(docs, labels).orderBy("doc_id").collect()
    b = toxicity.score_toxicity(docs, turned).orderBy("doc_id").collect()
    assert a == b


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(500).select(
        F.col("id").alias("doc_id"), F.array(F.col("id").cast("double")).alias("features")
    )
    labels = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("y"))
    x, y = labelled.training_sample(rows, labels, "doc_id", "y", 40)
    again, _ = labelled.training_sample(rows.repartition(7), labels, "doc_id", "y", 40)
    assert x.shape == (40, 1) and (x == again).all() and (x[:, 0] % 2 == y).all()
    assert not any(held(int(v)) for v in x[:, 0])


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x[:3000], y[:3000])
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.95
    bins = labelled.binned(x[:5], model.edges)
    by_hand = [
        model.base
        + sum(t[b] for t, b in zip(model.tables, row, strict=True))
        + sum(t[row[i], row[j]] for i, j, t in model.pairs)
        for row in bins
    ]
    assert np.allclose(model.score(x[:5]), labelled.sigmoid(np.array(by_hand)))


def test_boosted_trees_and_isotonic_calibration():
    rng = np.random.default_rng(6)
    x = rng.random((6000, 3))
    chance = np.where(x[:, 0] > 0.7, 0.9, np.where(x[:, 1] > 0.5, 0.4, 0.05))
    y = (rng.random(6000) < chance).astype(float)
    model = toxicity.fit_toxicity(x[:4000], y[:4000])
    score = model.score(x[4000:])
    for low, high in ((0, 0.2), (0.2, 0.6), (0.6, 1.01)):
        part = (score >= low) & (score < high)
        assert abs(score[part].mean() - y[4000:][part].mean()) < 0.08
    levels, means = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert np.interp([1, 2, 3, 4], levels, means).tolist() == [0, 0.5, 0.5, 1]


def features_of(module, texts):
    import pyarrow as pa

    from strata.llm.words import parts

    args = (toxicity.Lexicon(),) if module is toxicity else ()
    return np.concatenate([module._features(t, *args) for t in parts(pa.array(texts, pa.string()))])


def test_features_by_hand():
    f = dict(zip(quality.FEATURES, features_of(quality, ["Ab ab AB c! |\nd1"])[0], strict=True))
    assert f["same_as_last"] == pytest.approx(2 / 6) and f["distinct"] == pytest.approx(4 / 6)
    assert f["symbol_endings"] == pytest.approx(2 / 6) and f["capitals"] == pytest.approx(3 / 8)
    t = features_of(toxicity, ["You are an idiot, such a st*pid 1diot", "a fine day", "", None])
    named = dict(zip(toxicity.FEATURES, t[0], strict=True))
    assert named["log_hits"] == pytest.approx(np.log(2)) and named["log_disguised"] == pytest.approx(np.log(3))
    assert named["nearness"] == pytest.approx(1 / 4)
    assert t[1:, :8].max() == 0 and (t[2] == t[3]).all()


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_odd_rows(spark, odd_documents, no_documents, score):
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 0, 1), (5, 0, 1), (8, 1, 0), (None, 1, 1), (4, None, None)],
        "doc_id long, quality int, toxic int",
    )
    rows = score(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3)}
    assert len(empty) == 1
    assert score(no_documents, labels).count() == 0
    one_kind = score(odd_documents, labels.where("quality = 1 and toxic = 0")).collect()
    assert len({r["score"] for r in one_kind}) == 1
    nothing = score(odd_documents, labels.limit(0)).collect()
    assert {r["score"] for r in nothing} == {0.5}


def test_keeping_good_documents(spark):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    good = {r["doc_id"] for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == good
