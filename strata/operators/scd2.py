"""Type-2 slowly changing dimensions as DataFrame merges.

A dimension is its business columns plus ``_row_hash``, ``_valid_from``,
``_valid_to`` and ``_is_current``.  A merge closes the current row of every
changed key and inserts the new version in the same run; keys absent from the
batch stay current and equal hashes change nothing, so a replay is a no-op.
Batches with null keys fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import business_columns, row_hash
from strata.functions.stamps import Moment, moment

KEEP, CLOSE, INSERT = "keep", "close", "insert"


def with_row_hash(
    df: DataFrame, hash_cols: Sequence[str] | None = None, style: str = "null_as_empty"
) -> DataFrame:
    return df.withColumn("_row_hash", row_hash(hash_cols or business_columns(df), style))


def scd2_bootstrap(
    batch: DataFrame,
    as_of: Moment = None,
    hash_cols: Sequence[str] | None = None,
    style: str = "null_as_empty",
) -> DataFrame:
    """First load: every row is current from ``as_of`` on."""
    return with_row_hash(batch, hash_cols, style).withColumns(
        {
            "_valid_from": moment(as_of),
            "_valid_to": F.lit(None).cast("timestamp_ntz"),
            "_is_current": F.lit(True),
        }
    )


def evolve(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], hash_cols: Sequence[str] | None, style: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of either, gaps null; null keys fail.

    A batch with new columns has the hashes of the stored rows computed over
    the new set of columns, so rows in which the new columns are null do not
    count as changed.
    """
    system = ("_row_hash", "_valid_from", "_valid_to", "_is_current")
    stored = {f.name: f.dataType for f in current.schema if f.name not in system}
    arriving = {f.name: f.dataType for f in batch.schema if f.name not in system}
    added = [c for c in arriving if c not in stored]
    batch = batch.withColumns({c: F.lit(None).cast(t) for c, t in stored.items() if c not in arriving})
    batch = batch.withColumns(
        {k: F.coalesce(F.col(k), F.raise_error(F.lit(f"null key {k}")).cast(batch.schema[k].dataType)) for k in keys}
    ).select(*stored, *added)
    if added:
        wider = current.withColumns({c: F.lit(None).cast(arriving[c]) for c in added}).select(*stored, *added, *system)
        current = wider.withColumn("_row_hash", row_hash(hash_cols or business_columns(batch), style))
    return current, batch


def scd2_changes(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    as_of: Moment = None,
    hash_cols: Sequence[str] | None = None,
    style: str = "null_as_empty",
) -> DataFrame:
    """New fate of every current row and every new version, tagged ``_change``.

    ``current`` holds current rows only and ``batch`` one row per key, so no
    key repeats on either side of the full outer join and one join with one
    shuffle decides everything.  History never takes part.  Columns that only
    one side has are null on the other.
    """
    current, batch = evolve(current, batch, keys, hash_cols, style)
    columns = current.columns
    fresh = scd2_bootstrap(batch, as_of, hash_cols, style).select(*columns)
    old = current.select(*keys, F.struct(*columns).alias("_old"))
    new = fresh.select(*keys, F.struct(*columns).alias("_new"))
    joined = old.join(new, [*keys], "full_outer")

    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = has_old & has_new & ~F.col("_old._row_hash").eqNullSafe(F.col("_new._row_hash"))
    closed = F.struct(
        *[
            F.col("_new._valid_from").alias(c)
            if c == "_valid_to"
            else F.lit(False).alias(c)
            if c == "_is_current"
            else F.col(f"_old.{c}").alias(c)
            for c in columns
        ],
        F.lit(CLOSE).alias("_change"),
    )
    outcome = F.array(
        F.when(changed, closed).when(has_old, _tagged("_old", columns, KEEP)),
        F.when(changed | ~has_old, _tagged("_new", columns, INSERT)),
    )
    return joined.select(F.inline(F.array_compact(outcome)))


def scd2_changes_small_batch(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    as_of: Moment = None,
    hash_cols: Sequence[str] | None = None,
    style: str = "null_as_empty",
) -> DataFrame:
    """The same result for a batch far smaller than the dimension.

    Every join builds on something no larger than the batch, so below Spark's
    broadcast size the dimension is streamed twice (once for keys and hashes
    only) and never shuffled.  The batch is read three times: pass a stored
    one.
    """
    current, batch = evolve(current, batch, keys, hash_cols, style)
    columns = current.columns
    fresh = scd2_bootstrap(batch, as_of, hash_cols, style).select(*columns)
    incoming = fresh.select(
        *keys, F.col("_row_hash").alias("_new_hash"), F.col("_valid_from").alias("_closed_at")
    )
    changed = F.col("_closed_at").isNotNull() & ~F.col("_row_hash").eqNullSafe(F.col("_new_hash"))
    survivors = (
        current.join(incoming, [*keys], "left")
        .withColumns(
            {
                "_change": F.when(changed, CLOSE).otherwise(KEEP),
                "_valid_to": F.when(changed, F.col("_closed_at")).otherwise(F.col("_valid_to")),
                "_is_current": F.col("_is_current") & ~changed,
            }
        )
        .select(*columns, "_change")
    )
    same = current.select(*keys, "_row_hash").join(
        fresh.select(*keys, "_row_hash"), [*keys, "_row_hash"], "left_semi"
    )
    added = fresh.join(same, [*keys], "left_anti").withColumn("_change", F.lit(INSERT))
    return survivors.unionByName(added)


def scd2_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    as_of: Moment = None,
    hash_cols: Sequence[str] | None = None,
    style: str = "null_as_empty",
    small_batch: bool = False,
) -> DataFrame:
    """Whole dimension after the merge; closed history passes through untouched."""
    changes = scd2_changes_small_batch if small_batch else scd2_changes
    merged = changes(target.filter("_is_current"), batch, keys, as_of, hash_cols, style)
    return target.filter("NOT _is_current").unionByName(merged.drop("_change"), allowMissingColumns=True)


def scd2_metrics(changes: DataFrame) -> DataFrame:
    """Rows inserted and updated (closed) by a merge, from its tagged changes."""
    return changes.agg(
        F.count_if(F.col("_change") == INSERT).alias("rows_inserted"),
        F.count_if(F.col("_change") == CLOSE).alias("rows_updated"),
    )


def out_of_order(current: DataFrame, as_of: Moment) -> DataFrame:
    """Current rows that start at or after ``as_of``; a merge there would overlap."""
    return current.filter(F.col("_is_current") & (F.col("_valid_from") >= moment(as_of)))


def _tagged(side: str, columns: Sequence[str], change: str):
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], F.lit(change).alias("_change"))
