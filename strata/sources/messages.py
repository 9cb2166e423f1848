"""Keyed message streams: connector options, decoding and encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import struct


MESSAGE = struct(
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    key=T.BinaryType(),
    value=T.BinaryType(),
)
POSITION = {"_kafka_topic": "topic", "_kafka_partition": "partition", "_kafka_offset": "offset"}
_CORRUPT = "_corrupt_record"
#: Stamps are published to the microsecond.
_STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_options(servers: str, *topics: str, records: int | None = None, **more: str) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``records`` bounds a micro-batch.  Without a start position a new query
    begins at the oldest record; later it goes on where its checkpoint ends.
    Any other option of the source can be given, dots written as two
    underscores.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest"}
    if records is not None:
        options["maxOffsetsPerTrigger"] = str(records)
    return options | {name.replace("__", "."): value for name, value in more.items()}


def login(mechanism: str, user: str, password: str) -> dict[str, str]:
    """Options by which a source or sink logs in to its servers."""
    module = "plain.PlainLoginModule" if mechanism == "PLAIN" else "scram.ScramLoginModule"
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": f"org.apache.kafka.common.security.{module} required "
        f'username="{user}" password="{password}";',
    }


def parse_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Each message once: its position, ``payload`` text, ``record`` and ``bad``.

    A payload is bad when it is null, not JSON, or JSON of another shape than
    an object.  Store the result before taking both sides from it.
    """
    position = [F.col(source).alias(name) for name, source in POSITION.items()]
    text, record = _record(schema)
    parsed = raw.select(*position, text.alias("payload"), record.alias("record"))
    return parsed.withColumn("bad", ~_good(F.col("record")))


def _record(schema: T.StructType) -> tuple[Column, Column]:
    """The payload text, and the record in it with the parser's verdict."""
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    return text, F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _good(record: Column) -> Column:
    return record.isNotNull() & record[_CORRUPT].isNull()


def good_records(parsed: DataFrame, schema: T.StructType, payload_col: str | None = None) -> DataFrame:
    """The records of parsed messages with their positions.

    ``payload_col`` names a VARIANT column that holds the whole message, so
    fields that the schema lacks are kept and can be read by path
    (:func:`payload_field`).
    """
    return parsed.filter(~F.col("bad")).select(*_columns(schema, payload_col, F.col("payload")))


def skipped_messages(parsed: DataFrame) -> DataFrame:
    """Position and payload text of the bad ones among parsed messages."""
    return parsed.filter("bad").select(*POSITION, "payload")


def _columns(schema: T.StructType, payload_col: str | None, text: Column) -> list[Column]:
    whole = [payload_variant(text).alias(payload_col)] if payload_col else []
    return [*[F.col(f"record.{f.name}").alias(f.name) for f in schema], *[F.col(c) for c in POSITION], *whole]


def payload_variant(text: Column) -> Column:
    """A JSON text as VARIANT; what is no valid JSON stays a string."""
    return F.coalesce(F.try_parse_json(text), text.cast(T.VariantType()))


def payload_field(payload: str | Column, path: str, kind: str = "string") -> Column:
    """A field of a kept message by its path such as ``$.a.b[0]``; null if absent or of another kind."""
    return F.try_variant_get(payload, path, kind)


def decode_messages(
    raw: DataFrame, schema: T.StructType, payload_col: str | None = None, variant: bool = False
) -> DataFrame:
    """Good messages as records with their topic, partition and offset.

    ``payload_col`` keeps the whole payload beside the declared fields, as text
    or, with ``variant``, as VARIANT, so fields that the schema does not know
    are not lost.  The filter stands inside the generator: a filter behind the
    parser would be pushed below it and parse every message twice.
    """
    text, record = _record(schema)
    position = [F.col(source).alias(name) for name, source in POSITION.items()]
    kept = raw.select(*position, text.alias("_text"), F.explode(F.filter(F.array(record), _good)).alias("record"))
    if payload_col and not variant:
        return kept.select(*_columns(schema, None, F.col("_text")), F.col("_text").alias(payload_col))
    return kept.select(*_columns(schema, payload_col, F.col("_text")))


def bad_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The skipped messages: position and payload text."""
    return skipped_messages(parse_messages(raw, schema))


def encode_messages(df: DataFrame, key_col: str, topic: str | None = None) -> DataFrame:
    """Rows as keyed JSON messages, ready for a message sink."""
    encoded = {
        "key": F.encode(F.col(key_col).cast("string"), "UTF-8"),
        "value": F.encode(F.to_json(F.struct(*df.columns), _STAMPS), "UTF-8"),
    }
    if topic is not None:
        encoded = {"topic": F.lit(topic), **encoded}
    return df.select(*[c.alias(n) for n, c in encoded.items()])


def publish(df: DataFrame, key_col: str, fmt: str = "kafka", topic: str | None = None, **options: str) -> None:
    """Write rows to a topic, or to any other sink of the same columns."""
    rows = encode_messages(df, key_col, topic)
    rows.write.format(fmt).options(**options).mode("append").save()
