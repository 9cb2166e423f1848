"""Row counts gathered without a second pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def transform_metrics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in, rows out and duplicates dropped of a deduplication by ``keys``.

    Counted per key first (map-side combined), then summed: one shuffle of
    keys and counts, no window.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_dropped"),
    )


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Callable[..., Any]]:
    """``df`` that counts while it is written, and the reader for after the write.

    Always counts ``rows``; further named aggregates may be added.  Numbers
    that were not seen are 0, other values null.
    """
    watch = Observation()
    columns = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()]]
    watched = df.observe(watch, *columns)

    def read(name: str = "rows") -> Any:
        value = watch.get.get(name)
        return value if isinstance(value, str) or (value is None and name == "mark") else int(value or 0)

    return watched, read
