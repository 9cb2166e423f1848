"""High-water marks and incremental filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "1970-01-01"


def high_water_mark(df: DataFrame, col: str, default: str | None = None) -> DataFrame:
    """One row ``(high_water_mark)``: the largest value, the default if none.

    Without a default it is the epoch for dates and timestamps and null for
    other types.
    """
    kind = df.schema[col].dataType
    if default is None and isinstance(kind, T.DatetimeType):
        default = EPOCH
    return df.agg(F.coalesce(F.max(col), F.lit(default).cast(kind)).alias("high_water_mark"))


def newer_than(
    df: DataFrame,
    col: str,
    target: DataFrame,
    target_col: str | None = None,
    lookback: str | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``col`` is strictly above the mark of ``target``.

    The mark is a scalar subquery: it runs once, on the cluster, and its value
    reaches the scan as a filter.  A target without a mark has taken nothing
    yet, so a first run loads every row, those with a null or early stamp too;
    whether there is a mark is looked up once, from one row.  ``lookback`` (an interval such as
    ``'2 days'``) re-reads late rows; ``partition_col`` is a date partition of
    ``df`` that holds the day of ``col`` and is pruned with the same mark.
    """
    marked = target_col or col
    if target.where(F.col(marked).isNotNull()).select(marked).isEmpty():
        return df
    mark = _mark(target, marked, lookback)
    kept = df.filter(F.col(col) > mark.scalar())
    if partition_col:
        day = mark.select(F.to_date(F.col("high_water_mark")))
        kept = kept.filter(F.col(partition_col) >= day.scalar())
    return kept


def newer_than_value(df: DataFrame, col: str, value: str | Column) -> DataFrame:
    """Rows above a known mark, compared in the column's own type."""
    mark = value if isinstance(value, Column) else F.lit(value).cast(df.schema[col].dataType)
    return df.filter(F.col(col) > mark)


def _mark(target: DataFrame, col: str, lookback: str | None) -> DataFrame:
    mark = high_water_mark(target, col)
    if lookback is None:
        return mark
    return mark.select((F.col("high_water_mark") - F.expr(f"interval {lookback}")).alias("high_water_mark"))
