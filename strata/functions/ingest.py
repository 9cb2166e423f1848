"""Arrival metadata added on the way into bronze."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.stamps import Moment, epoch_micros, moment


def with_ingest_metadata(
    df: DataFrame,
    source: str,
    batch_id: str | Column | None = None,
    as_of: Moment = None,
    with_date: bool = True,
) -> DataFrame:
    """Append ``_ingestion_ts``, ``_source``, ``_batch_id`` and, when asked,
    the partition column ``_ingestion_date``.

    The batch id is one literal for the whole batch, so a retried task writes
    the same value.
    """
    stamp = moment(as_of)
    batch = batch_id if batch_id is not None else str(uuid.uuid4())
    added = {
        "_ingestion_ts": stamp,
        "_source": F.lit(source),
        "_batch_id": batch if isinstance(batch, Column) else F.lit(batch),
    }
    if with_date:
        added["_ingestion_date"] = F.to_date(stamp)
    return df.withColumns(added)


def epoch_batch_id(source: str, as_of: Moment = None) -> Column:
    """Batch id of the JSON landing: the source and whole epoch seconds."""
    seconds = F.floor(epoch_micros(moment(as_of)) / F.lit(1_000_000))
    return F.concat_ws("_", F.lit(source), seconds.cast("string"))


def hour_path(stamp: Column) -> Column:
    """Landing folder of an instant, ``yyyy/MM/dd/HH``."""
    return F.date_format(stamp, "yyyy/MM/dd/HH")
