"""Paged sources, messages and streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.checks import ingestion
from strata.session import struct
from strata.sources import bronze
from strata.sources.messages import (
    MESSAGE, bad_messages, decode_messages, encode_messages, login, payload_field, publish, read_options,
)
from strata.sources.paged import PagedApi, page_records, paged_source, read_pages, until_last_page
from strata.sources.versions import VersionedTable
from strata.streaming.ingest import (
    KEY_BUCKET, bronze_handler, dedup_handler, known_keys, read_files, run_batches, unknown_rows,
)
from tests.test_silver import bag

ID = struct(id=T.LongType())


def served(*pages):
    """A fetcher over fixed pages; past the end they are empty."""

    def fetch(params):
        number = params["page"]
        return {"results": pages[number - 1] if number <= len(pages) else []}

    return fetch


def records(n, start=0):
    return [{"id": start + i} for i in range(n)]


def collected(spark, api, name, **options):
    pages = spark.createDataFrame(read_pages(spark, api, name, **options).collect(), "page LONG, n_records LONG, has_next BOOLEAN, body STRING")
    return pages, page_records(until_last_page(pages, api.page_size), ID)


def test_single_short_page(spark):
    pages, got = collected(spark, PagedApi(served(records(5)), page_size=10), "p1")
    assert pages.count() == 1 and got.count() == 5


def test_two_pages_and_all_records(spark):
    _, got = collected(spark, PagedApi(served(records(10), records(3, 10)), page_size=10), "p2")
    assert sorted(r["id"] for r in got.collect()) == list(range(13))


def test_empty_answer(spark):
    _, got = collected(spark, PagedApi(served([]), page_size=10), "p3")
    assert got.count() == 0


def test_full_last_page_needs_an_empty_one_to_end(spark):
    _, got = collected(spark, PagedApi(served(records(10), records(10, 10)), page_size=10), "p4", pages_per_task=1)
    assert got.count() == 20


def test_rows_after_a_short_page_are_cut(spark):
    api = PagedApi(served(records(10), records(4, 10), records(10, 20), records(10, 30)), page_size=10)
    _, got = collected(spark, api, "p5", pages_per_task=1)
    assert sorted(r["id"] for r in got.collect()) == list(range(14))


def test_many_pages_are_read_by_many_tasks(spark):
    api = PagedApi(served(*[records(2, 2 * i) for i in range(9)]), page_size=2)
    df = read_pages(spark, api, "p6", pages_per_task=4)
    assert df.rdd.getNumPartitions() == 4  # the doubling stops at page 16
    assert page_records(until_last_page(df, 2), ID).count() == 18


def test_cursor_links_are_followed_in_order(spark):
    def fetch(params):
        at = int(params.get("cursor", 0))
        if at == 8:
            return {"results": records(1, at)}
        return {"results": records(2, at), "next": f"https://x.io/a?cursor={at + 2}"}

    api = PagedApi(fetch, page_size=2, extra_params={"q": "z"})
    df = read_pages(spark, api, "p7", follow_cursor=True)
    assert df.rdd.getNumPartitions() == 1
    assert sorted(r["id"] for r in page_records(df, ID).collect()) == list(range(9))


def test_request_parameters():
    seen = []
    api = PagedApi(lambda p: seen.append(p) or {"results": []}, page_size=7, page_param="p", limit_param="n", extra_params={"a": 1})
    api.get(3, {"c": "x", "p": "9"})
    assert seen == [{"n": 7, "a": 1, "c": "x", "p": 3}]
    assert paged_source(api, "named").name() == "named"


def test_records_of_every_body_shape(spark):
    bodies = ['{"results":[{"id":1},{"id":2}]}', '[{"id":3}]', '{"id":4}', '{"results":[]}', '{"results":null}']
    df = spark.createDataFrame([(b,) for b in bodies], "body STRING")
    assert sorted(r["id"] for r in page_records(df, ID).collect()) == [1, 2, 3, 4]


def test_topic_options():
    plain = read_options("localhost:9092", "a", "b", records=1000)
    assert plain == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    more = read_options("b:9093", "t", startingOffsets="latest", kafka__group__id="g") | login("PLAIN", "u", "p")
    assert more["startingOffsets"] == "latest" and more["kafka.group.id"] == "g" and "maxOffsetsPerTrigger" not in more
    assert 'PlainLoginModule required username="u" password="p"' in more["kafka.sasl.jaas.config"]


def topic(spark, *payloads):
    values = [("t", i % 2, i, b"k", None if p is None else p.encode()) for i, p in enumerate(payloads)]
    return spark.createDataFrame(values, MESSAGE)


PAYLOADS = ['{"id": 1}', "plain", "5", "[1]", None, '{"id": "x"}', "{}", '{"id": 2, "other": 3}', ""]


def test_bad_payloads_are_set_aside(spark):
    raw = topic(spark, *PAYLOADS)
    good = decode_messages(raw, ID)
    assert good.columns == ["id", "_kafka_topic", "_kafka_partition", "_kafka_offset"]
    bad = bad_messages(raw, ID)
    assert good.count() + bad.count() == len(PAYLOADS)
    assert sorted(r["_kafka_offset"] for r in good.collect() if r["id"] is not None) == [0, 7]
    assert {1, 2, 3, 4} <= {r["_kafka_offset"] for r in bad.collect()}


def test_publish_to_any_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id LONG, name STRING")
    row = encode_messages(df, "id", "t").first()
    assert (row["topic"], bytes(row["key"]), bytes(row["value"])) == ("t", b"1", b'{"id":1,"name":"a"}')
    path = str(tmp_path / "sink")
    publish(df, "id", fmt="parquet", path=path)
    assert spark.read.parquet(path).columns == ["key", "value"]


def test_failed_batch_is_delivered_again_and_stored_once(spark, tmp_path):
    landing, offsets = str(tmp_path / "in"), str(tmp_path / "offsets")
    for i in range(3):
        topic(spark, f'{{"id": {i}}}', "bad").coalesce(1).write.mode("append").parquet(landing)
    good, bad = VersionedTable(spark, str(tmp_path / "good")), VersionedTable(spark, str(tmp_path / "bad"))
    handle = bronze_handler(ID, good, bad, stream_id="s", as_of="2024-01-01")
    failures = iter([True])

    def dies_after_writing(batch, number):
        handle(batch, number)
        if number == 1 and next(failures, False):
            raise RuntimeError("lost between write and commit")

    def run(handler):
        stream = read_files(spark, landing, files_per_batch=1)
        run_batches(stream, handler, offsets).awaitTermination()

    with pytest.raises(Exception, match="lost between"):
        run(dies_after_writing)
    run(dies_after_writing)
    assert sorted(r["id"] for r in good.current().collect()) == [0, 1, 2]
    assert bad.current().count() == 3
    assert {r["_batch_id"] for r in good.current().collect()} == {"s-0", "s-1", "s-2"}


def test_idle_trigger_keeps_running(spark, tmp_path):
    landing = str(tmp_path / "in")
    topic(spark, '{"id": 1}').write.parquet(landing)
    seen = []
    query = run_batches(
        read_files(spark, landing), lambda b, n: seen.append(b.count()), str(tmp_path / "o"), idle_seconds=0.1, name="idle"
    )
    try:
        query.processAllAvailable()
        assert seen == [1] and query.isActive and query.name == "idle"
    finally:
        query.stop()


def test_redelivered_rows_are_dropped_and_late_ones_kept(spark, tmp_path):
    landing, offsets = (str(tmp_path / p) for p in ("in", "off"))
    out = VersionedTable(spark, str(tmp_path / "out"))

    def deliver(*ids):
        stamp = F.when(F.col("id") != 9, F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int")))
        rows = spark.createDataFrame([(i,) for i in ids], "id LONG").withColumn("ts", stamp)
        rows.write.mode("append").parquet(landing)
        stream = read_files(spark, landing, rows.schema)
        run_batches(stream, dedup_handler(out, ["id"], "ts"), offsets).awaitTermination()
        return [r[0] for r in bag(out.current().select("id"))]

    assert deliver(2, 3, 3, 9) == [2, 3, 9]
    assert deliver(3, 2, 9, 0) == [0, 2, 3, 9]  # days late and new
    assert deliver(0, 1, 9) == [0, 1, 2, 3, 9]


def test_unknown_fields_and_repeated_batches(spark, tmp_path):
    kept = decode_messages(topic(spark, '{"id": 1, "note": "keep me"}'), ID, "payload").first()
    assert (kept["id"], kept["payload"]) == (1, '{"id": 1, "note": "keep me"}')
    path = str(tmp_path / "bronze")
    rows = spark.range(5)
    assert [bronze.append(rows, path, "s", b, "2024-01-01") for b in ("b1", "b1", "b2")] == [5, 0, 5]
    assert spark.read.parquet(path).count() == 10


def test_whole_messages_are_kept_as_variant(spark):
    rows = topic(spark, '{"id": 1, "deep": {"a": [1, {"b": 2.5}]}, "id2": "x"}', '{"id": 2, "a": 1, "a": 2}', "bad", None)
    got = decode_messages(rows, ID, "payload", variant=True)
    assert got.schema["payload"].dataType.simpleString() == "variant"
    read = got.select(
        "id", payload_field("payload", "$.deep.a[1].b", "double").alias("b"), payload_field("payload", "$.id2", "int").alias("i")
    )
    assert sorted(tuple(r) for r in read.collect()) == [(1, 2.5, None), (2, None, None)]
    plan = decode_messages(rows, ID, "payload", variant=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") == 1


def test_keys_are_looked_up_in_touched_buckets_only(spark, tmp_path):
    out = VersionedTable(spark, str(tmp_path / "out"))
    handle = dedup_handler(out, ["a", "b"], "ts", n_buckets=8)
    rows = spark.createDataFrame([(i, None if i % 2 else "x", i) for i in range(50)], "a INT, b STRING, ts INT")
    handle(rows, 0)
    handle(rows.withColumn("ts", F.col("ts") + 1000).unionByName(rows.selectExpr("a + 40", "b", "ts").toDF("a", "b", "ts")), 1)
    got = {(r["a"], r["b"]): r["ts"] for r in out.current().collect()}
    assert len(got) == 90 == out.current().count() and got[(3, None)] == 3 and got[(55, None)] == 15
    index = known_keys(out, ["a", "b"], 8)
    few = rows.filter("a = 7").withColumn(KEY_BUCKET, F.lit(5))
    plan = unknown_rows(index, few, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert KEY_BUCKET in pruned and "5" in pruned


def test_crash_between_rows_and_keys_stores_rows_once(spark, tmp_path, monkeypatch):
    out = VersionedTable(spark, str(tmp_path / "out"))
    rows = spark.createDataFrame([(i, i) for i in range(20)], "a INT, ts INT")
    handle = dedup_handler(out, ["a"], "ts")
    handle(rows.filter("a < 5"), 0)
    real = VersionedTable.append

    def dies(self, *args, **kwargs):
        if self.path.endswith("keys"):
            raise RuntimeError("lost")
        return real(self, *args, **kwargs)

    monkeypatch.setattr(VersionedTable, "append", dies)
    with pytest.raises(RuntimeError):
        handle(rows, 1)
    monkeypatch.setattr(VersionedTable, "append", real)
    handle(rows, 1)
    handle(rows.withColumn("ts", F.lit(99)), 2)
    assert sorted(tuple(r) for r in out.current().collect()) == [(i, i) for i in range(20)]


def test_key_index_of_an_older_table_is_made_on_first_use(spark, tmp_path):
    out = VersionedTable(spark, str(tmp_path / "out"))
    rows = spark.createDataFrame([(1, 1), (2, 2)], "a INT, ts INT")
    out.append(rows)
    dedup_handler(out, ["a"], "ts")(rows.selectExpr("a + 1 AS a", "ts"), 0)
    assert sorted(r["a"] for r in out.current().collect()) == [1, 2, 3]


def test_a_landed_topic_has_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """One task sorts a file, so its messages must not grow with the topic; copies and null keys stay."""
    monkeypatch.setattr(ingestion, "MESSAGES_PER_FILE", 200, raising=False)
    key = F.when(F.col("id") % 100 == 9, None).when(F.col("id") % 100 == 8, F.col("id") - 1).otherwise(F.col("id"))
    events = spark.range(4000).select(
        key.alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(0.5).alias("value"), F.lit("{}").alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    landed = spark.read.parquet(ingestion._landed_messages(spark, str(tmp_path)))
    sizes = landed.groupBy(F.input_file_name().alias("file"), "partition").count().groupBy("file").agg(F.sum("count").alias("n"))
    assert max(r["n"] for r in sizes.collect()) < 2 * 200
    assert bag(landed) == bag(ingestion.messages(spark, str(tmp_path)))
    assert ingestion.stream_bad(spark, str(tmp_path)).count() == bad_messages(landed, ingestion.EVENT).count() > 300
