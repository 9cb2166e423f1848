"""Layout, maintenance, quality, vectors and catalog search."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import catalog, layout, packing, quality
from strata.operators.vectors import approximate_topk, centroid, text_vectorizer, text_vectors, vector_topk
from strata.sources.bucketed import BucketedTable
from strata.sources.versions import VersionedTable
from tests.test_silver import bag


def hot(spark, n=30_000):
    """A third of the rows share one value in both columns."""
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000)
    other = F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id", F.lit(1)) % 1000)
    return spark.range(n).select("id", value.alias("a"), other.alias("b"))


def files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_zorder_spreads_a_hot_value_and_keeps_all_rows(spark, tmp_path):
    path = str(tmp_path / "z")
    layout.zorder(hot(spark), ["a", "b"], 9).write.parquet(path)
    stored = spark.read.parquet(path)
    assert bag(stored.select("id")) == bag(spark.range(30_000))
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 3 * 30_000 / 9


def test_curve_interleaves_ranks_of_any_type(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c"), (3, "d")], "n INT, s STRING")
    got = {r["s"]: r["_curve"] for r in layout.with_curve(df, ["n", "s"], bits=2).collect()}
    assert got["a"] < got["b"] < got["c"] <= got["d"]
    with pytest.raises(ValueError):
        layout.with_curve(df, ["n"] * 8, bits=8)


def test_rewrite_touches_only_partitions_with_many_files(spark, tmp_path):
    path = str(tmp_path / "p")
    df = hot(spark, 3000).withColumn("part", F.when(F.col("a") == 7, None).otherwise(F.col("id") % 2))
    many = F.col("part").isNull() | (F.col("part") == 0)
    df.filter(many).repartition(6, "id").write.partitionBy("part").parquet(path)
    df.filter(~many).coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    quiet = set(files(f"{path}/part=1"))
    size = sum(os.path.getsize(f"{path}/part=0/{f}") for f in files(f"{path}/part=0"))
    touched = layout.rewrite_partitions(spark, path, ["part"], target_bytes=size // 2)
    assert touched == 2 and set(files(f"{path}/part=1")) == quiet
    assert 1 <= len(files(f"{path}/part=0")) <= 3
    assert bag(spark.read.parquet(path).select("id")) == bag(spark.range(3000))
    for strategy in ("sort", "zorder"):
        layout.rewrite_partitions(spark, path, ["part"], ["a", "b"], strategy, min_input_files=1)
        assert spark.read.parquet(path).count() == 3000
    assert layout.rewrite_partitions(spark, path, ["part"]) == 0


def test_rewrite_keeps_folder_names_that_look_like_numbers(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(60).withColumn("part", F.concat(F.lit("0"), F.col("id") % 2))
    df.repartition(6, "id").write.partitionBy("part").parquet(path)
    assert layout.rewrite_partitions(spark, path, ["part"]) == 2
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["part=00", "part=01"]
    assert spark.read.parquet(path).count() == 60


def test_optimize_keeps_versions_and_reports(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(2):
        table.append(spark.range(10 * i, 10 * i + 10).repartition(4))
    record = layout.optimize(table, name="t").first()
    assert (record["files_before"], record["files_after"], record["rows"]) == (8, 1, 20)
    assert table.as_of_version(0).count() == 10 and table.current().count() == 20
    stats = layout.table_stats(layout.live_files(table), ["d"]).first()
    assert stats["num_files"] == 1 and stats["partitioning"] == ["d"]


def test_maintenance_isolates_errors(spark):
    def steps(entry):
        if entry["name"] == "b":
            raise RuntimeError("boom")

    manifest = [{"layer": "silver", "name": n} for n in "abc"]
    got = [(r["name"], r["status"], r["error"]) for r in layout.run_maintenance(spark, manifest, steps).collect()]
    assert got == [("a", "OK", None), ("b", "ERR", "RuntimeError: boom"), ("c", "OK", None)]


def test_quality_rules_treat_null_as_failure(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (None, -1.0)], "id INT, amount DOUBLE")
    rules = [quality.not_null("id"), quality.non_negative("amount")]
    good, bad = quality.quarantine(df, rules)
    assert bag(good) == [(1, 1.0)]
    assert {r["amount"]: r["_failed"] for r in bad.collect()} == {
        None: ["amount_non_negative"],
        -1.0: ["id_not_null", "amount_non_negative"],
    }
    gate = {r["rule"]: r for r in quality.quality_gate(df, rules, threshold=0.5).collect()}
    assert gate["id_not_null"]["gate_passed"] and not gate["all_rules"]["gate_passed"]
    assert gate["all_rules"]["pass_ratio"] == pytest.approx(1 / 3)
    assert all(r["gate_passed"] for r in quality.quality_gate(df.filter("false"), rules).collect())
    assert bag(quality.assert_non_negative(df, "amount", ["id"])) == [(None, -1.0)]


def test_topk_against_numpy(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(50, 8)).astype("float32")
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id LONG, embedding ARRAY<FLOAT>")
    query = data[3].astype("float64")
    want = sorted(range(50), key=lambda i: -float(data[i].astype("float64") @ query))[:5]
    assert [r["vec_id"] for r in vector_topk(vectors, query.tolist(), 5).collect()] == want
    top = vector_topk(vectors, query.tolist(), 1, metric="cosine").first()
    assert (top["vec_id"], top["score"]) == (3, 1.0)
    assert np.allclose(centroid(vectors), data.astype("float64").mean(axis=0), atol=1e-5)
    near = approximate_topk(vectors, query.tolist(), 3, bucket_length=8.0)
    assert near.orderBy("distance").first()["vec_id"] == 3


def test_catalog_crawl_documents_and_search(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "order_id INT, status STRING").write.mode("overwrite").option(
        "path", str(tmp_path / "o")
    ).saveAsTable("crawl_orders")
    try:
        tables, columns = catalog.crawl(spark, schemas=["default"])
        assert {r["full_name"] for r in catalog.list_tables(tables).collect()} >= {"spark_catalog.default.crawl_orders"}
        got = columns.filter("table_name = 'crawl_orders'").orderBy("position").collect()
        assert [(r["name"], r["type"]) for r in got] == [("order_id", "int"), ("status", "string")]
        assert catalog.visible_tables(tables, ["elsewhere"]).count() == 0
        text = catalog.documents(*(d.filter("table_name = 'crawl_orders'") for d in (tables, columns))).first()
        assert text["document"] == (
            "spark_catalog.default.crawl_orders\n* order_id int\n* status string"
        )
    finally:
        spark.sql("DROP TABLE crawl_orders")


def test_profiles_and_sample_lines(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (1, None), (9, "b"), (5, "c"), (2, "d")], "n INT, s STRING")
    assert catalog.profile(df) == {"row_count": 6, "samples": {"n": ["1", "2", "3"], "s": ["a", "b", "c"]}}
    assert catalog.profile(df.filter("false")) == {"row_count": 0, "samples": {}}
    frames = {"t": df}
    docs = catalog.documents(*catalog.describe_frames(spark, frames), *catalog.profiles(spark, frames))
    text = docs.first()["document"]
    assert text == "spark.main.t holds 6 rows\n* n int e.g. 1 / 2 / 3\n* s string e.g. a / b / c"


def test_index_upsert_and_search(spark):
    schema = "full_name STRING, catalog STRING, document STRING"
    first = spark.createDataFrame([("c.s.a", "c", "old text"), ("c.s.b", "c", "customer revenue by region")], schema)
    second = spark.createDataFrame([("c.s.a", "c", "shipping dates and carriers"), ("c.s.d", "c", "web page visits")], schema)
    docs = catalog.index_upsert(first, second)
    assert docs.count() == 3 and docs.filter("document = 'old text'").count() == 0
    model = text_vectorizer(docs)
    index = text_vectors(docs, model)
    assert catalog.search(index, model, "total revenue per customer", k=1).first()["full_name"] == "c.s.b"
    assert catalog.search(index, model, "carriers", k=2).count() == 2


def test_rewrites_keep_all_columns_maps_and_unpartitioned_folders(spark, tmp_path):
    path = str(tmp_path / "evolved")
    for extra in ("beta", "gamma"):
        rows = spark.range(4).select("id", F.lit(extra).alias(extra), F.create_map(F.lit("k"), F.col("id")).alias("m"), F.lit("x").alias("p"))
        rows.repartition(3).write.mode("append").partitionBy("p").parquet(path)
    assert layout.rewrite_partitions(spark, path, ["p"], min_input_files=2) == 1
    back = spark.read.parquet(path)
    assert set(back.columns) == {"id", "beta", "gamma", "m", "p"} and back.count() == 8
    flat = str(tmp_path / "flat")
    spark.range(20).repartition(6).write.parquet(flat)
    assert layout.rewrite_partitions(spark, flat, [], ["id"], "sort", min_input_files=2) == 1
    assert spark.read.parquet(flat).count() == 20 and len(spark.read.parquet(flat).inputFiles()) == 1


def test_curve_tells_long_texts_apart(spark):
    names = spark.range(1000).select(F.format_string("Customer#%09d", "id").alias("name"))
    assert layout.with_curve(names, ["name"]).select("_curve").distinct().count() > 200
    assert layout.curve_bits(1, 4000) == 14 and layout.curve_bits(2, 16) == 8


def test_texts_are_ranked_among_bounds_made_once(spark):
    bounds = sorted([b"", b"a'b", "\u00e9".encode(), b"\x00", b"zz", b"zz", b"\xff\xfe"])
    texts = ["", "a", "a'b", "a'bc", "zz", "zzz", "\u00e9", "\uffff", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    ranked = df.select("t", layout.text_rank(F.col("t"), bounds, 3).alias("rank"))
    want = {t: 0 if t is None else sum(b <= t.encode() for b in bounds) for t in texts}
    assert {r["t"]: r["rank"] for r in ranked.collect()} == want
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" not in plan and "array(" not in plan


def test_packing_plan_fills_groups_and_leaves_large_files(spark):
    sizes = [(f"/t/p={p}/f{i}", n, p) for p, ns in {"a": [10, 20, 30, 40, 60, 70], "b": [5, 5], "c": [45] * 9}.items() for i, n in enumerate(ns)]
    files = spark.createDataFrame(sizes, "path STRING, length LONG, p STRING")
    plan = packing.packing_plan(files, ["p"], 100, 3).groupBy("p", "group").agg(F.sum("length"), F.count("*"))
    got = sorted((r[0], r[2], r[3]) for r in plan.collect())
    assert got == [("a", 100, 4), *[("c", 90, 2)] * 4]


def test_interrupted_packing_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    df = spark.range(400).withColumn("part", F.col("id") % 2)
    df.repartition(6, "id").write.partitionBy("part").parquet(path)
    real = packing._finish

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(packing, "_finish", dies)
    with pytest.raises(RuntimeError):
        layout.rewrite_partitions(spark, path, ["part"])
    monkeypatch.setattr(packing, "_finish", real)
    assert len(files(f"{path}/part=0")) == 6
    assert packing.recover(spark, path) == 1
    assert [len(files(f"{path}/part={i}")) for i in (0, 1)] == [1, 1] and not os.path.exists(f"{path}/_packing")
    assert bag(spark.read.parquet(path).select("id")) == bag(spark.range(400))
    assert packing.recover(spark, path) == 0


def test_packing_works_in_rounds_and_merges_schemas(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_FILES", 4)
    path = str(tmp_path / "p")
    for i in range(3):
        more = spark.range(60).withColumn("part", F.col("id") % 5).withColumn(f"c{i}", F.lit(i))
        more.repartition(2, "id").write.mode("append").partitionBy("part").parquet(path)
    assert layout.rewrite_partitions(spark, path, ["part"]) == 5
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    assert stored.count() == 180 and [stored.filter(F.col(f"c{i}") == i).count() for i in range(3)] == [60] * 3
    assert all(len(files(f"{path}/part={i}")) == 1 for i in range(5))


def test_optimize_rewrites_only_fragmented_buckets(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "b"), keys=("id",), n_buckets=4)
    rows = spark.range(2000).withColumn("v", F.lit(1))
    table.overwrite(rows)
    table.rewrite([2], lambda df: df.repartition(7, "id"))
    assert table.current().count() == 2000
    before = {r["path"] for r in layout.live_files(table).filter("_bucket <> 2").collect()}
    record = layout.optimize(table).first()
    live = layout.live_files(table)
    assert {r["path"] for r in live.filter("_bucket <> 2").collect()} == before
    assert live.filter("_bucket = 2").count() == 1 and record["files_before"] - record["files_after"] == 6
    assert bag(table.current().select("id")) == bag(spark.range(2000))
    assert layout.optimize(table).first()["rows"] == 0
    table.merge(spark.createDataFrame([(5, 9), (5000, 9)], "id LONG, v INT"))
    assert table.current().count() == 2001 and table.current().filter("v = 9").count() == 2
