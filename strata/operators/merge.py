"""Keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import settle


def checked_keys(source: DataFrame, keys: Sequence[str], nulls: bool = False) -> DataFrame:
    """``source``, refused if a key stands in two rows or, unless ``nulls``, is null.

    Of two rows for one key neither is the right one, and null keys match
    nothing, so they would multiply with every replay.
    """
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    found = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(~null & (F.col("_n") > 1) if nulls else null | (F.col("_n") > 1))
        .limit(1)
        .collect()
    )
    if found:
        key = tuple(found[0][k] for k in keys)
        raise ValueError(f"source key {key} is " + ("null" if None in key else "repeated"))
    return source


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    deleted: DataFrame | None = None,
    stored: bool = False,
) -> DataFrame:
    """New content of ``target`` after merging ``source``, one row per key there.

    Without ``update_cols`` a matched row is replaced whole: the target rows
    the source does not name, plus the source.  With ``update_cols`` only
    those columns are overwritten and the rest keep the old value.  A null key
    matches nothing, so such source rows are inserted; a source with repeated
    keys is refused.  ``deleted`` holds keys whose rows
    leave the target, such as facts that have become invalid.

    The source is used by the check and by both branches, so it is computed
    once and stored, unless the caller says that it is ``stored`` already.

    In both forms the target is the streamed side and the source the built
    one, so Spark broadcasts a small source by its size and the target is not
    shuffled; a large source gives a sort-merge join.
    """
    source = source.select(*target.columns)
    source = checked_keys(source if stored else settle(source, "merge-source"), keys, nulls=True)
    if deleted is not None:
        target = target.join(deleted.select(*keys).distinct(), [*keys], "left_anti")
    if update_cols is None:
        kept = target.join(source.select(*keys), [*keys], "left_anti")
        return kept.unionByName(source)

    update = set(update_cols)
    incoming = source.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in target.columns if c in update],
        F.lit(True).alias("_matched"),
    )
    updated = target.join(incoming, [*keys], "left").select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select(*keys).join(source.select(*keys), [*keys], "left_semi")
    return updated.unionByName(source.join(known, [*keys], "left_anti"))


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many source rows an upsert updates and inserts."""
    known = target.select(*keys, F.lit(True).alias("_known")).dropDuplicates([*keys])
    marked = source.select(*keys).join(known, [*keys], "left")
    return marked.agg(
        F.count("_known").alias("rows_updated"),
        F.count_if(F.col("_known").isNull()).alias("rows_inserted"),
    )
