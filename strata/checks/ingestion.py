"""Paged sources, messages, streams and cross-format joins."""

from __future__ import annotations

import json
import math

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.checks.fixtures import AS_OF, messages, table, with_inputs
from strata.functions import query_params
from strata.session import scratch_dir, settle, struct
from strata.sources.messages import bad_messages, decode_messages, encode_messages, payload_field
from strata.sources.paged import PagedApi, page_records, read_pages, until_last_page
from strata.sources.versions import VersionedTable
from strata.streaming.ingest import bronze_handler, dedup_handler, read_files, run_batches, run_some_batches

ORDER = struct(o_orderkey=T.LongType(), o_custkey=T.LongType(), o_totalprice=T.DoubleType())
EVENT = struct(
    event_id=T.LongType(),
    event_type=T.StringType(),
    user_id=T.LongType(),
    props=T.StringType(),
    value=T.DoubleType(),
    ts=T.TimestampNTZType(),
)
POSITION = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]


class LandedPages:
    """The service behind a paged source: one file per page, opened when the page is asked for."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def __call__(self, params: dict) -> dict:
        store, root = fs.FileSystem.from_uri(self.folder)
        place = fs.FileSelector(f"{root}/page={params['page']}", allow_not_found=True)
        bodies = [f.path for f in store.get_file_info(place) if f.extension == "txt"]
        if not bodies:
            return {"results": []}
        with store.open_input_stream(bodies[0]) as body:
            return json.loads(body.read())


def land_pages(rows: DataFrame, key: str, page_size: int) -> str:
    """Write rows as numbered pages of JSON records, in the order of the key; returns the folder.

    Rows are numbered within ranges of the key and the ranges by the rows
    before them, so gaps in the keys leave none in the pages, and no task holds
    more than its range.
    """
    spark = rows.sparkSession
    ranged = settle(
        rows.repartitionByRange(F.col(key)).withColumn("_range", F.spark_partition_id()), "ranged", ["_range"]
    )
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1 + F.col("before")
    record = F.struct(*[F.col(c) for c in rows.columns])
    pages = (
        ranged.join(starts, "_range")
        .select(F.floor(number / page_size).alias("_before"), key, record.alias("record"))
        .groupBy((F.col("_before") + 1).alias("page"))
        .agg(F.sort_array(F.collect_list("record")).alias("results"))
    )
    folder = scratch_dir(spark, "pages")
    body = F.to_json(F.struct("results"))
    pages.repartition("page").select("page", body.alias("value")).write.partitionBy("page").text(folder)
    return folder


def _order_pages(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Every page of the orders, fetched from the files of a service and landed once."""
    api = PagedApi(LandedPages(land_pages(orders, "o_orderkey", 500)), page_size=500)
    return until_last_page(settle(read_pages(spark, api, "order_pages"), "pages"), api.page_size)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*ORDER.fieldNames())


def paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(_order_pages(spark, _orders(spark, sf_dir)), ORDER)


def paged_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with wide gaps: the pages have none, so no order is missed."""
    sparse = _orders(spark, sf_dir).withColumn("o_orderkey", F.col("o_orderkey") * 1000 + F.col("o_custkey") % 7)
    return page_records(_order_pages(spark, sparse), ORDER)


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_pages(spark, _orders(spark, sf_dir)).select("page", "n_records")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from three shapes of body: an envelope, a bare list, a bare record."""
    nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    record = F.struct("c_custkey", "c_name")
    bodies = nation.select(
        F.when(F.col("c_nationkey") < 10, F.to_json(F.struct(F.array(record).alias("results"))))
        .when(F.col("c_nationkey") < 20, F.to_json(F.array(record)))
        .otherwise(F.to_json(record))
        .alias("body")
    )
    return page_records(bodies, struct(c_custkey=T.LongType(), c_name=T.StringType()))


def cursor_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = query_params(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.try_element_at(params, F.lit("page")).alias("page"),
        F.try_element_at(params, F.lit("ref")).alias("ref"),
        F.size(params).cast("bigint").alias("n_params"),
    )


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded, stored as a sink would hold them, and decoded again."""
    path = scratch_dir(spark, "encoded")
    rows = table(spark, sf_dir, "events").select(*EVENT.fieldNames())
    encode_messages(rows, "user_id", "events").write.parquet(path)
    stored = spark.read.parquet(path).withColumns(
        {"partition": F.lit(0), "offset": F.lit(None).cast("bigint")}
    )
    decoded = decode_messages(stored.withColumn("_key", F.decode("key", "UTF-8")), EVENT)
    keys = stored.groupBy(F.decode("key", "UTF-8").cast("bigint").alias("user_id")).agg(
        F.count(F.lit(1)).alias("keyed")
    )
    return decoded.select(*EVENT.fieldNames()).join(keys, "user_id")


# -- streams -----------------------------------------------------------------


#: Messages in one file of a landed topic, which one task sorts, and bytes of its parts that are read apart.
MESSAGES_PER_FILE, PART_BYTES = 500_000, 16 * 1024 * 1024


def _landed_messages(spark: SparkSession, sf_dir: str) -> str:
    """The topic as files, each a range of a topic partition or of some, and of bounded size."""
    path = scratch_dir(spark, "topic")
    rows = messages(spark, sf_dir)
    n_files = max(4, math.ceil(rows.count() / MESSAGES_PER_FILE))
    ranged = rows.repartitionByRange(n_files, "partition", "offset").sortWithinPartitions("partition", "offset")
    ranged.write.option("parquet.block.size", PART_BYTES).parquet(path)
    return path


def _ingested(
    spark: SparkSession, sf_dir: str, deliveries: int = 1, schema: T.StructType = EVENT, payload_col: str | None = None
) -> tuple[VersionedTable, VersionedTable]:
    good = VersionedTable(spark, scratch_dir(spark, "stream-good"))
    bad = VersionedTable(spark, scratch_dir(spark, "stream-bad"))
    handle = bronze_handler(schema, good, bad, stream_id="events", as_of=AS_OF, payload_col=payload_col)

    def deliver(batch: DataFrame, number: int) -> None:
        for _ in range(deliveries):
            handle(batch, number)

    stream = read_files(spark, _landed_messages(spark, sf_dir), files_per_batch=2)
    run_batches(stream, deliver, scratch_dir(spark, "stream-offsets")).awaitTermination()
    return good, bad


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir)[0].current().drop("_batch_id")


def stream_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored messages of which one field is declared; the others come from the kept payload."""
    good, _ = _ingested(spark, sf_dir, schema=struct(event_id=T.LongType()), payload_col="_payload")
    return good.current().select(
        "event_id",
        payload_field("_payload", "$.event_type").alias("event_type"),
        payload_field("_payload", "$.user_id", "bigint").alias("user_id"),
        payload_field("_payload", "$.value", "double").alias("value"),
        payload_field("_payload", "$.none").alias("none"),
    )


def stream_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir)[1].current().select(*POSITION, "payload")


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is delivered twice and stored once."""
    return _ingested(spark, sf_dir, deliveries=2)[0].current().select("event_id", *POSITION)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of a topic in four files; a second run goes on with what is left.

    Shows which run stored each message.
    """
    landing, offsets = scratch_dir(spark, "some-topic"), scratch_dir(spark, "some-offsets")
    messages(spark, sf_dir).repartitionById(4, F.col("partition")).write.parquet(landing)
    stored = VersionedTable(spark, scratch_dir(spark, "some-batches"))
    runs = []
    for run in (0, 1):
        handle = bronze_handler(EVENT, stored, source=f"run {run}", stream_id="some", as_of=AS_OF, payload_col=None)
        runs.append(run_some_batches(read_files(spark, landing, files_per_batch=1), handle, offsets, most=3))
    per_run = stored.current().groupBy(F.col("_source").alias("run")).agg(F.count_distinct("_kafka_partition").alias("files"))
    total = stored.current().agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("event_id").alias("events"))
    counted = F.element_at(F.lit(runs), (F.substring("run", 5, 1).cast("int") + 1)).cast("bigint").alias("batches")
    return per_run.select("run", "files", counted, *[total.select(c).scalar().alias(c) for c in total.columns])


def stream_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that runs on takes what lands later, a partial batch at each interval."""
    landing, offsets = scratch_dir(spark, "idle-in"), scratch_dir(spark, "idle-offsets")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    stored = VersionedTable(spark, scratch_dir(spark, "idle-out"))
    parts = [events.filter(F.col("event_id") % 2 == part) for part in (0, 1)]
    parts[0].write.parquet(landing)
    query = run_batches(
        read_files(spark, landing, events.schema),
        lambda batch, number: stored.append(batch, batch_id=f"idle-{number}"),
        offsets,
        idle_seconds=0.2,
    )
    try:
        query.processAllAvailable()
        parts[1].write.mode("append").parquet(landing)
        query.processAllAvailable()
    finally:
        query.stop()
    batches = stored.commits().agg(F.count(F.lit(1)))
    return stored.current().withColumn("batches", batches.scalar())


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later events arrive; then all of them are delivered, so that the
    earlier ones come late for the first time and the rest are copies."""
    landing, offsets = (scratch_dir(spark, f"dedup-{part}") for part in ("in", "offsets"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp"))
    out = VersionedTable(spark, scratch_dir(spark, "dedup-out"))
    for part in (events.filter("event_id % 3 > 0"), events, events):
        part.write.mode("append").parquet(landing)
        handle = dedup_handler(out, ["event_id"], "ts")
        run_batches(read_files(spark, landing, events.schema), handle, offsets).awaitTermination()
    return out.current().withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_dedup_restamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the events arrive, then all of them a day later: copies
    with another stamp are not stored, the rest is, late as it is."""
    landing, offsets = (scratch_dir(spark, f"dedup-{part}") for part in ("in", "offsets"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    out = VersionedTable(spark, scratch_dir(spark, "dedup-out"))
    again = events.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(1)))
    for part in (events.filter("event_id % 3 > 0"), again):
        part.write.mode("append").parquet(landing)
        handle = dedup_handler(out, ["event_id"], "ts", n_buckets=16)
        run_batches(read_files(spark, landing, events.schema), handle, offsets).awaitTermination()
    return out.current()


# -- federation ----------------------------------------------------------------


def federated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet customers, CSV nations and JSON regions in one join."""
    nations, regions = scratch_dir(spark, "nations"), scratch_dir(spark, "regions")
    table(spark, sf_dir, "nation").write.option("header", True).csv(nations)
    table(spark, sf_dir, "region").write.json(regions)
    nation = spark.read.schema("n_nationkey INT, n_name STRING, n_regionkey INT").csv(nations, header=True)
    region = spark.read.schema("r_regionkey INT, r_name STRING").json(regions)
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))
    )


QUERIES = {
    "paged_source": paged_source,
    "paged_gaps": paged_gaps,
    "page_counts": page_counts,
    "page_records": envelopes,
    "cursor_params": cursor_params,
    "decode_messages": lambda s, d: decode_messages(messages(s, d), EVENT),
    "bad_messages": lambda s, d: bad_messages(messages(s, d), EVENT),
    "encode_messages": encoded,
    "stream_ingest": stream_ingest,
    "stream_bad_messages": stream_bad,
    "stream_bronze": stream_bronze,
    "stream_batches": stream_batches,
    "stream_idle": stream_idle,
    "stream_dedup": stream_dedup,
    "stream_dedup_restamped": stream_dedup_restamped,
    "stream_payload": stream_payload,
    "federated_join": federated_join,
}

_ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
_GOOD = """
  SELECT event_id, event_type, user_id, props, value, ts, topic AS _kafka_topic, part AS _kafka_partition,
         pos AS _kafka_offset{extra}
  FROM messages WHERE kind = '{{}}'"""
_BAD = """
  SELECT topic AS _kafka_topic, part AS _kafka_partition, pos AS _kafka_offset, kind AS payload
  FROM messages WHERE kind IS DISTINCT FROM '{}'"""
_INGESTED = """, TIMESTAMP '2024-02-01 00:00:00' AS _ingestion_ts, 'kafka' AS _source,
         DATE '2024-02-01' AS _ingestion_date"""

ORACLES = {
    "paged_source": _ORDERS,
    "paged_gaps": "SELECT o_orderkey * 1000 + o_custkey % 7 AS o_orderkey, o_custkey, o_totalprice FROM orders",
    "page_counts": """
      SELECT o_orderkey // 500 + 1 AS page, count(*) AS n_records FROM orders GROUP BY 1
      UNION ALL
      SELECT count(*) // 500 + 1, 0 FROM orders HAVING count(*) % 500 = 0""",
    "page_records": "SELECT c_custkey, c_name FROM customer",
    "cursor_params": """
      SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
             nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref,
             CAST(len(regexp_extract_all(regexp_extract(url, '[?][^#]*'), '[?&][^=&]+=[^&]+')) AS BIGINT) AS n_params
      FROM pages""",
    "decode_messages": with_inputs("messages", _GOOD.format(extra="")),
    "bad_messages": with_inputs("messages", _BAD),
    "encode_messages": """
      SELECT event_id, event_type, user_id, props, value, ts, count(*) OVER (PARTITION BY user_id) AS keyed FROM events""",
    "stream_ingest": with_inputs("messages", _GOOD.format(extra=_INGESTED)),
    "stream_bad_messages": with_inputs("messages", _BAD),
    "stream_bronze": with_inputs(
        "messages",
        """ SELECT event_id, topic AS _kafka_topic, part AS _kafka_partition, pos AS _kafka_offset
            FROM messages WHERE kind = '{}'""",
    ),
    "stream_batches": with_inputs(
        "messages",
        """
        SELECT 'run ' || r AS run, CAST(CASE r WHEN 0 THEN 3 ELSE 1 END AS BIGINT) AS files, CAST(CASE r WHEN 0 THEN 3 ELSE 1 END AS BIGINT) AS batches,
               count(*) FILTER (WHERE kind = '{}') AS messages, count(DISTINCT event_id) FILTER (WHERE kind = '{}') AS events
        FROM messages, range(2) t(r) GROUP BY r""",
    ),
    "stream_idle": "SELECT event_id, user_id, value, CAST(2 AS BIGINT) AS batches FROM events",
    "stream_dedup": "SELECT event_id, event_type, value, ts FROM events",
    "stream_dedup_restamped": """
      SELECT event_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts
      FROM events""",
    "stream_payload": with_inputs(
        "messages", " SELECT event_id, event_type, user_id, value, CAST(NULL AS VARCHAR) AS none FROM messages WHERE kind = '{}'"
    ),
    "federated_join": """
      SELECT r_name, c_mktsegment, count(*) AS customers,
             CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY 1, 2""",
}
