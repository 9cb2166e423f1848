"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.stamps import Moment, moment


def _ordered(kind: T.DataType) -> bool:
    """Whether values of a type have an order: none with a map or a variant inside."""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "_ingestion_ts",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row of each key.

    All rows of one batch carry the same stamp, so ties are normal; they are
    decided by the remaining columns, largest first, nulls last.  The rank
    filter lets Spark keep one row per key and map task before the shuffle
    (``WindowGroupLimit``), so a hot key cannot overload its reducer.
    """
    if tie_break is None:
        tie_break = [
            f.name
            for f in df.schema
            if f.name not in keys and f.name != order_col and _ordered(f.dataType)
        ]
    order = [F.col(c).desc_nulls_last() for c in (order_col, *tie_break)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def to_silver(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "_ingestion_ts",
    as_of: Moment = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Deduplicate and stamp the promotion day ``_silver_date``."""
    latest = dedupe_latest(df, keys, order_col, tie_break)
    return latest.withColumn("_silver_date", F.to_date(moment(as_of)))


def replace_with_latest(
    df: DataFrame, keys: Sequence[str], order_col: str = "_ingestion_ts"
) -> DataFrame:
    """Type-1 silver: rows with an arrival time, newest per key."""
    return dedupe_latest(df.filter(F.col(order_col).isNotNull()), keys or ["id"], order_col)
