"""Message streams into bronze, with an effectively-once sink."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
)

from strata.functions.ingest import with_ingest_metadata
from strata.functions.stamps import Moment
from strata.operators.layout import hashable
from strata.session import scratch_scope, settle
from strata.sources.messages import MESSAGE, decode_messages, good_records, parse_messages, skipped_messages
from strata.sources.versions import VersionedTable

Handler = Callable[[DataFrame, int], None]


def read_topic(spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka") -> DataFrame:
    """A stream of messages from a topic connector, by the connector's options."""
    stream = spark.readStream.format(fmt).options(**options).load()
    return stream.select(*MESSAGE.fieldNames())


def read_files(
    spark: SparkSession, path: str, schema: T.StructType = MESSAGE, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over files that land in ``path``; ``files_per_batch`` bounds a
    micro-batch as the record count does for a topic."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_batches(
    stream: DataFrame,
    handler: Handler,
    checkpoint: str,
    idle_seconds: float | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Call ``handler(batch, batch_number)`` per micro-batch; the offsets are
    committed after it returns, so a failed batch is delivered again.

    Without ``idle_seconds`` the query takes what is there and ends; with it,
    it runs on and flushes at that interval.
    """
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if idle_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{idle_seconds} seconds").start()


class _Enough(Exception):
    """Ends a query before it handles a batch more than it was asked for."""


class _Progress(StreamingQueryListener):
    """Counts the batches of one query that are committed, and tells when there are enough."""

    def __init__(self, most: int) -> None:
        self.most, self.batches, self.enough = most, set(), threading.Event()
        self.run_id: str | None = None

    def onQueryStarted(self, event: QueryStartedEvent) -> None:  # noqa: N802  (Spark's name)
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:  # noqa: N802
        progress = event.progress
        if str(progress.runId) == self.run_id and progress.numInputRows:
            self.batches.add(progress.batchId)
            if len(self.batches) >= self.most:
                self.enough.set()

    def onQueryIdle(self, event: QueryIdleEvent) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:  # noqa: N802
        pass


def run_some_batches(
    stream: DataFrame, handler: Handler, checkpoint: str, most: int, name: str | None = None
) -> int:
    """Handle at most ``most`` micro-batches and return how many there were.

    A listener counts the committed batches and the query is stopped when they
    are enough.  It may have fetched one more by then: that batch is refused
    before it is handled, so its offsets stay open and the next run begins
    with it.
    """
    if most < 1:
        return 0
    spark, handled = stream.sparkSession, []

    def guarded(batch: DataFrame, number: int) -> None:
        if len(handled) >= most:
            raise _Enough(f"batch {number} is left for the next run")
        handler(batch, number)
        handled.append(number)

    progress = _Progress(most)
    spark.streams.addListener(progress)
    try:
        query = run_batches(stream, guarded, checkpoint, name=name)
        progress.run_id = str(query.runId)
        while query.isActive and not progress.enough.wait(0.1):
            pass
        query.stop()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if len(handled) < most:  # the handler's own error
                raise
    finally:
        spark.streams.removeListener(progress)
    return len(handled)


def bronze_handler(
    schema: T.StructType,
    good: VersionedTable,
    bad: VersionedTable | None = None,
    source: str = "kafka",
    stream_id: str = "stream",
    as_of: Moment = None,
    payload_col: str | None = "_payload",
) -> Handler:
    """A handler that decodes a batch and appends it to ``good`` (and the
    skipped messages to ``bad``).  The batch is fetched and parsed once.

    Unless ``payload_col`` is None the whole message is kept under it as
    VARIANT.  The batch number makes the batch id, and a committed id is not
    written again: at-least-once delivery gives exactly one copy in the table.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream_id}-{number}"
        with scratch_scope(good.spark):
            if bad is None:
                records = decode_messages(batch, schema, payload_col, variant=True)
            else:
                parsed = settle(parse_messages(batch, schema), "stream-batch")
                records = good_records(parsed, schema, payload_col)
                skipped = with_ingest_metadata(skipped_messages(parsed), source, batch_id, as_of)
                bad.append(skipped, batch_id=batch_id, committed_at=as_of)
            good.append(with_ingest_metadata(records, source, batch_id, as_of), batch_id=batch_id, committed_at=as_of)

    return handle


KEY_BUCKET = "_key_bucket"


def known_keys(table: VersionedTable, keys: Sequence[str], n_buckets: int = 64) -> VersionedTable:
    """The keys that ``table`` holds, in hash buckets beside it.

    A table that was filled before it had this index gets it on first use.
    """
    index = VersionedTable(table.spark, f"{table.path}/keys", (KEY_BUCKET,))
    if index.latest() is None and table.latest() is not None:
        index.overwrite(_with_bucket(table.current().select(*keys).distinct(), keys, n_buckets), "create")
    return index


def _with_bucket(rows: DataFrame, keys: Sequence[str], n_buckets: int) -> DataFrame:
    return rows.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int"))


def unknown_rows(index: VersionedTable, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` (with their key bucket) whose keys the index lacks; only the buckets they touch are read."""
    touched = [r[0] for r in rows.select(KEY_BUCKET).distinct().collect()]  # at most the number of buckets
    if index.latest() is None:
        return rows
    known = index.current().filter(F.col(KEY_BUCKET).isin(touched))
    named = known.select(*[F.col(k).alias(f"_known_{k}") for k in (KEY_BUCKET, *keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in (KEY_BUCKET, *keys)]
    return rows.join(named, reduce(lambda a, b: a & b, same), "left_anti")


def dedup_handler(
    table: VersionedTable, keys: Sequence[str], ts_col: str, stream_id: str = "stream", n_buckets: int = 64
) -> Handler:
    """A handler that appends the rows of a batch whose keys ``table`` lacks.

    Keys are looked up in hash buckets (:func:`known_keys`), so a batch is
    compared with the buckets it touches and with key columns only, whatever
    its stamps: a new row is stored however late it comes, a copy never, not
    even under another stamp.  Of copies in one batch the earliest stays.

    The rows are committed before their keys and both under the batch id, so a
    batch that is delivered again after a crash between the two adds the keys
    and nothing else.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch_id = f"{stream_id}-{number}"
        earliest = Window.partitionBy(*keys).orderBy(F.col(ts_col).asc_nulls_last(), F.xxhash64(*hashable(batch)))
        first = batch.withColumn("_nth", F.row_number().over(earliest)).filter("_nth = 1").drop("_nth")
        with scratch_scope(table.spark):
            rows = settle(_with_bucket(first, keys, n_buckets), "stream-dedup")
            index = known_keys(table, keys, n_buckets)
            news = settle(unknown_rows(index, rows, keys), "stream-news")
            table.append(news.drop(KEY_BUCKET), batch_id=batch_id)
            index.append(news.select(*keys, KEY_BUCKET).repartition(KEY_BUCKET), batch_id=batch_id)

    return handle
