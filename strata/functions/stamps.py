"""The one clock of a job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = Column | datetime | str | None


def moment(as_of: Moment = None) -> Column:
    """``as_of`` as a TIMESTAMP_NTZ column in UTC; the wall clock if unset.

    All system columns share this type, so comparing two of them needs no cast
    and stays pushable to the scan, and no result depends on the session zone.
    """
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def epoch_micros(stamp: Column) -> Column:
    """Microseconds since 1970 of a UTC stamp."""
    return F.unix_micros(F.concat(stamp.cast("string"), F.lit("Z")).cast("timestamp"))


def from_epoch_seconds(seconds: Column) -> Column:
    """UTC stamp of (maybe fractional) epoch seconds."""
    local = F.timestamp_seconds(seconds).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit("UTC"), local)
