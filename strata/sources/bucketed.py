"""Versioned tables that rewrite only the key buckets a batch touches.

Rows are laid out as ``_version=N/.../_bucket=b`` with the bucket a hash of the
merge keys.  A key never changes its bucket, so a merge reads and rewrites the
buckets of its batch and nothing else; the commit lists them, and a reader
takes each bucket from the newest commit that wrote it.  The bucket count
bounds all lists.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.stamps import Moment
from strata.operators.merge import checked_keys, upsert
from strata.operators.scd2 import out_of_order, scd2_bootstrap, scd2_changes, with_row_hash
from strata.operators.schema_sync import conform
from strata.session import scratch_scope, settle
from strata.sources.versions import VersionedTable, carried, evolved, latest_commit, next_version, stored_schema

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketedTable(VersionedTable):
    keys: tuple[str, ...] = ()
    n_buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int")

    def append(self, df: DataFrame, batch_id: str | None = None, committed_at: Moment = None) -> Row:
        raise NotImplementedError("a bucketed table is keyed: merge into it, or overwrite it")

    def merge(
        self,
        source: DataFrame,
        update_cols: Sequence[str] | None = None,
        batch_id: str | None = None,
        committed_at: Moment = None,
        deleted: DataFrame | None = None,
    ) -> Row:
        """Upsert ``source`` (one row per key), rewriting its buckets only.

        ``deleted`` holds keys whose rows leave the table.  The table takes the columns of the source: new ones are null in rows
        it does not touch, missing ones leave the current schema.
        """
        with scratch_scope(self.spark):
            return self._merge(source, update_cols, batch_id, committed_at, deleted)

    def _merge(
        self,
        source: DataFrame,
        update_cols: Sequence[str] | None,
        batch_id: str | None,
        committed_at: Moment,
        deleted: DataFrame | None,
    ) -> Row:
        last, done = self._state(batch_id)
        if done is not None:
            return done
        if last is None:
            return self.overwrite(source, "merge", batch_id, committed_at)
        self._check_layout(last)
        if last["current_base"] is not None:
            raise ValueError(f"{self.path}: a type-2 table takes type-2 merges only")
        source = settle(source, "batch")
        schema = evolved(stored_schema(last), source.schema, keep_missing=False)
        touched = self._touched(source)
        if deleted is not None:
            deleted = settle(deleted.select(*self.keys), "deleted")
            touched = sorted({*touched, *self._touched(deleted)})
        target = conform(self._buckets_of(last, touched), schema, drop_unknown=True)
        merged = upsert(target, source, self.keys, update_cols, deleted, stored=True)
        version = next_version(last)
        rows = self._write(merged, version)()
        return self._commit(
            version, last["base"], "merge", batch_id, committed_at, merged.schema, rows, buckets=touched,
            marks=carried(last),
        )

    def merge_scd2(
        self,
        batch: DataFrame,
        as_of: Moment = None,
        hash_cols: Sequence[str] | None = None,
        style: str = "null_as_empty",
        batch_id: str | None = None,
        marks: dict[str, str] | None = None,
    ) -> Row:
        """Type-2 merge of ``batch`` (one row per key).

        Rows the dimension already holds are set aside first by key and hash,
        so a full snapshot with few changes rewrites few buckets and a replay
        rewrites none.  Closed rows are appended to the history.  A batch with
        null or repeated keys is refused, and so is one whose changes do not
        lie after the rows they would close.
        """
        with scratch_scope(self.spark):
            return self._merge_scd2(batch, as_of, hash_cols, style, batch_id, marks)

    def _merge_scd2(
        self,
        batch: DataFrame,
        as_of: Moment,
        hash_cols: Sequence[str] | None,
        style: str,
        batch_id: str | None,
        marks: dict[str, str] | None,
    ) -> Row:
        last, done = self._state(batch_id)
        if done is not None:
            return done
        batch = checked_keys(settle(batch, "batch"), self.keys)
        if last is None:
            first = scd2_bootstrap(batch, as_of, hash_cols, style)
            changes = first.withColumn("_change", F.lit("insert"))
            return self.apply_scd2(changes, batch_id, as_of, marks=marks)
        self._check_layout(last)
        # After an overwrite (restore, compaction) the base holds the current rows too.
        current_base = last["base"] if last["current_base"] is None else last["current_base"]
        hashed = with_row_hash(batch, hash_cols, style)
        known = self._buckets_of(last, self._touched(hashed)).filter("_is_current")
        identity = [*self.keys, "_row_hash"]
        news = settle(hashed.join(known.select(*identity), identity, "left_anti"), "news").drop("_row_hash")
        touched = self._touched(news)
        if not touched:
            return self._commit(
                next_version(last),
                last["base"],
                "merge",
                batch_id,
                as_of,
                known.schema,
                rows_added=0,
                current_base=current_base,
                buckets=[],
                marks=carried(last, marks),
            )
        current = self._buckets_of(last, touched).filter("_is_current")
        if as_of is not None:
            closing = out_of_order(current, as_of).join(news.select(*self.keys), [*self.keys], "left_semi")
            if not closing.isEmpty():
                raise ValueError(f"{self.path}: batch as of {as_of} is not after the current rows")
        changes = scd2_changes(current, news, self.keys, as_of, hash_cols, style)
        return self.apply_scd2(changes, batch_id, as_of, current_base, touched, marks)

    def rewrite(self, buckets: Sequence[int], shape: Callable[[DataFrame], DataFrame]) -> Row:
        """Write some buckets again in another shape (``shape`` sees ``_bucket``); the rest stays.

        Of a type-2 table the current rows are written; history is not read.
        """
        last = self._required(latest_commit(self.commits()), "no commits")
        content = self._buckets_of(last, buckets)
        if last["current_base"] is not None:
            content = content.filter("_is_current")
        version = next_version(last)
        rows = self._write(content, version, shape=lambda df: shape(df.withColumn(BUCKET, self.bucket())))()
        return self._commit(
            version, last["base"], "optimize", None, None, stored_schema(last), rows,
            current_base=last["current_base"], buckets=sorted(buckets), marks=carried(last),
        )

    # -- layout ----------------------------------------------------------

    def folder_fields(self) -> list[T.StructField]:
        return [*super().folder_fields(), T.StructField(BUCKET, T.IntegerType())]

    def live_filter(self, commit: Row) -> Column:
        """Each bucket from the newest commit that wrote it; closed rows of a
        type-2 table from every commit since the base."""
        typed = commit["current_base"] is not None
        base = commit["current_base"] if typed else commit["base"]
        version, bucket = F.col("_version"), F.col(BUCKET)
        writers = self._writers(base, commit["version"])
        live = (version == base) & ~bucket.isin(list(writers))
        for writer in sorted(set(writers.values())):
            live = live | ((version == writer) & bucket.isin([b for b, v in writers.items() if v == writer]))
        if not typed:
            return live
        history = version.between(commit["base"], commit["version"])
        return (F.col("_is_current") & live) | (~F.col("_is_current") & history)

    def _writers(self, base: int, version: int) -> dict[int, int]:
        """Newest writer of every bucket rewritten after ``base``."""
        later = self._all_commits().filter((F.col("version") > base) & (F.col("version") <= version))
        newest = later.select("version", F.explode("buckets").alias("b")).groupBy("b").agg(F.max("version").alias("v"))
        return {row["b"]: row["v"] for row in newest.collect()}

    def _touched(self, batch: DataFrame) -> list[int]:
        return sorted(row["b"] for row in batch.select(self.bucket().alias("b")).distinct().collect())

    def _buckets_of(self, commit: Row, buckets: Sequence[int]) -> DataFrame:
        return self._content(commit, F.col(BUCKET).isin(list(buckets)))

    def _shape(self, df: DataFrame) -> DataFrame:
        """Bring each bucket together; AQE splits what is too large for a file."""
        return df.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)

    def _check_layout(self, last: Row) -> None:
        if last["n_buckets"] != self.n_buckets:
            raise ValueError(f"{self.path} has {last['n_buckets']} buckets, not {self.n_buckets}")

    def _bucket_count(self) -> int | None:
        return self.n_buckets

    def _folders(self) -> tuple[str, ...]:
        return (*self.partition_cols, BUCKET)
