"""Versioned tables on plain Parquet folders.

A table is ``<path>/data/_version=N/...`` plus a small commit table.  A commit
names the first version its content starts at (``base``): version ``v`` holds
the rows of every folder from ``base`` to ``v``.

* An append writes only its rows and keeps the base.
* Overwrite, merge, restore and compaction write the content again under a new
  version, which becomes its own base.  Nothing that is being read is replaced.
* A type-2 merge keeps the base for closed rows, so history is only ever
  appended to; its current rows start at ``current_base``.

The commit row is written last and readers go by commits, so a lost driver
leaves the old version readable and the retry overwrites the orphan folder.
One writer at a time is assumed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.stamps import Moment, moment
from strata.operators.metrics import observed
from strata.operators.scd2 import CLOSE, INSERT
from strata.operators.schema_sync import schema_changes
from strata.session import child_folders, delete_path, path_exists, read_or_empty, struct

COMMITS = struct(
    version=T.LongType(),
    base=T.LongType(),
    current_base=T.LongType(),
    snapshot_id=T.LongType(),
    batch_id=T.StringType(),
    committed_at=T.TimestampNTZType(),
    operation=T.StringType(),
    rows_added=T.LongType(),
    rows_removed=T.LongType(),
    schema_json=T.StringType(),
    buckets=T.ArrayType(T.IntegerType()),
    n_buckets=T.IntegerType(),
    marks=T.MapType(T.StringType(), T.StringType()),
)
#: Before a column's name: the end of the rows that an incremental build has settled.
SETTLED = "settled:"
VERSION_ONLY = struct(version=T.LongType())


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str
    partition_cols: tuple[str, ...] = ()
    sort_cols: tuple[str, ...] = ()

    # -- commits ---------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per commit still kept."""
        expired = f"{self.path}/expired"
        if not path_exists(self.spark, expired):
            return self._all_commits()
        gone = self.spark.read.schema(VERSION_ONLY).parquet(expired)
        return self._all_commits().join(gone, "version", "left_anti").select(*COMMITS.fieldNames())

    def latest(self) -> Row | None:
        return latest_commit(self.commits()).first()

    # -- reads -----------------------------------------------------------

    def current(self) -> DataFrame:
        return self._content(self._required(latest_commit(self.commits()), "no commits"))

    def as_of_version(self, version: int) -> DataFrame:
        found = self.commits().filter(F.col("version") == version)
        return self._content(self._required(found, f"version {version} not found"))

    def as_of_snapshot(self, snapshot_id: int) -> DataFrame:
        found = self.commits().filter(F.col("snapshot_id") == snapshot_id)
        return self._content(self._required(found, f"snapshot {snapshot_id} not found"))

    def as_of_timestamp(self, at: Moment) -> DataFrame:
        earlier = self.commits().filter(F.col("committed_at") <= moment(at))
        return self._content(self._required(latest_commit(earlier), f"no commit at or before {at}"))

    def since(self, version: int | None) -> DataFrame:
        """Rows of the newest version that folders after ``version`` hold; all without one."""
        last = self._required(latest_commit(self.commits()), "no commits")
        return self._content(last, None if version is None else F.col("_version") > version)

    def current_rows(self) -> DataFrame:
        """Only the current rows of a type-2 table; history is not read."""
        return self.current().filter("_is_current")

    def _required(self, found: DataFrame, message: str) -> Row:
        row = found.first()
        if row is None:
            raise LookupError(f"{self.path}: {message}")
        return row

    def _content(self, commit: Row, only: Column | None = None) -> DataFrame:
        """Rows of one commit, by partition-pruned folders and its own schema."""
        schema = stored_schema(commit)
        stored = T.StructType([*schema.fields, *self.folder_fields()])
        data = self._folders_between(commit["base"], commit["version"], stored)
        live = self.live_filter(commit)
        return data.filter(live if only is None else live & only).select(*schema.fieldNames())

    def _folders_between(self, first: int, last: int, schema: T.StructType) -> DataFrame:
        """The folders of some versions and no others, so that Spark lists their files only."""
        root = f"{self.path}/data"
        folders = [f for f in child_folders(self.spark, root) if f.startswith("_version=")]
        wanted = [f"{root}/{f}" for f in folders if first <= int(f.removeprefix("_version=")) <= last]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*wanted)

    def folder_fields(self) -> list[T.StructField]:
        """Partition columns of the folders that are not columns of the table."""
        return [T.StructField("_version", T.LongType())]

    def live_filter(self, commit: Row) -> Column:
        """Which folders a commit reads; touches partition columns only."""
        version = F.col("_version")
        live = version.between(commit["base"], commit["version"])
        if commit["current_base"] is not None:
            live = live & (~F.col("_is_current") | (version >= commit["current_base"]))
        return live

    # -- writes ----------------------------------------------------------

    def create_if_missing(self, schema: T.StructType, committed_at: Moment = None) -> Row:
        """An empty first version, unless the table exists."""
        return self.latest() or self.overwrite(
            self.spark.createDataFrame([], schema), operation="create", committed_at=committed_at
        )

    def append(
        self,
        df: DataFrame,
        batch_id: str | None = None,
        committed_at: Moment = None,
        drop_missing: bool = False,
        mark_col: str | None = None,
    ) -> Row:
        """Add rows; a batch id that was committed before changes nothing.

        ``mark_col`` keeps the largest value of a column in the commit, taken
        while the rows are written (:meth:`mark`).

        New columns join the schema and are null in old rows.  Columns the
        batch lacks stay, or with ``drop_missing`` leave the current schema;
        older versions keep them either way.
        """
        last, done = self._state(batch_id)
        if done is not None:
            return done
        version = next_version(last)
        schema = df.schema
        if last is not None and last["current_base"] is not None:
            raise ValueError(f"{self.path}: a type-2 table takes merges only")
        if last is not None:
            schema = evolved(stored_schema(last), schema, keep_missing=not drop_missing)
        counts = self._write(df, version, **_watched_mark(mark_col))
        return self._commit(
            version, version if last is None else last["base"], "append", batch_id, committed_at, schema, counts(),
            marks=_marks(last, counts, mark_col, _kind(df, mark_col)),
        )

    def overwrite(
        self,
        df: DataFrame,
        operation: str = "overwrite",
        batch_id: str | None = None,
        committed_at: Moment = None,
        rows_removed: int | None = None,
        mark_col: str | None = None,
    ) -> Row:
        """Replace the whole content and its schema."""
        last, done = self._state(batch_id)
        if done is not None:
            return done
        version = next_version(last)
        counts = self._write(df, version, **_watched_mark(mark_col))
        return self._commit(
            version, version, operation, batch_id, committed_at, df.schema, counts(), rows_removed,
            marks=_marks(None, counts, mark_col, _kind(df, mark_col)),
        )

    def replace_open(
        self, rows: DataFrame, mark_col: str, settled_to: str | None, batch_id: str | None = None,
        committed_at: Moment = None,
    ) -> Row:
        """Append the settled rows of an incremental build and replace its open ones.

        ``rows`` has ``_is_current`` (the table's partition column), true for
        open rows.  Settled rows written before are neither read nor written.
        The commit keeps the mark of ``mark_col`` and the end of what is settled.
        """
        last, done = self._state(batch_id)
        if done is not None:
            return done
        version = next_version(last)
        counts = self._write(rows, version, **_watched_mark(mark_col))
        return self._commit(
            version, version if last is None else last["base"], "append", batch_id, committed_at, rows.schema, counts(),
            current_base=version,
            marks={
                **(_marks(last, counts, mark_col, _kind(rows, mark_col)) or {}),
                **({} if settled_to is None else {f"{SETTLED}{mark_col}": settled_to}),
            },
        )

    def mark(self, col: str) -> str | None:
        """The largest value of ``col`` that writes with ``mark_col`` have kept, as text."""
        last = self.latest()
        return None if last is None else (last["marks"] or {}).get(col)

    def apply_scd2(
        self,
        changes: DataFrame,
        batch_id: str | None = None,
        committed_at: Moment = None,
        current_base: int | None = None,
        buckets: Sequence[int] | None = None,
        marks: dict[str, str] | None = None,
    ) -> Row:
        """Commit the tagged changes of a type-2 merge.

        Closed rows are appended to the history and the current rows written
        anew; earlier history is neither read nor copied.  The commit counts
        inserted rows as added and closed ones as removed, taken while the
        data is written.
        """
        last, done = self._state(batch_id)
        if done is not None:
            return done
        version = next_version(last)
        counts = self._write(
            changes,
            version,
            drop=["_change"],
            inserted=F.count_if(F.col("_change") == INSERT),
            closed=F.count_if(F.col("_change") == CLOSE),
        )
        return self._commit(
            version,
            version if last is None else last["base"],
            "merge",
            batch_id,
            committed_at,
            changes.drop("_change").schema,
            counts("inserted"),
            counts("closed"),
            current_base=version if current_base is None else current_base,
            buckets=buckets,
            marks=carried(last, marks),
        )

    def restore(self, version: int, committed_at: Moment = None) -> Row:
        """Make an earlier version the newest one again."""
        return self.overwrite(self.as_of_version(version), "restore", committed_at=committed_at)

    # -- expiry ----------------------------------------------------------

    def expire_by_age(self, retain_hours: int = 168, now: Moment = None) -> DataFrame:
        return self.expire(keep_younger_than(self.commits(), retain_hours, now))

    def expire_keep_last(self, retain_last: int = 10) -> DataFrame:
        return self.expire(keep_last(self.commits(), retain_last))

    def expire(self, keep: DataFrame) -> DataFrame:
        """Forget the commits not in ``keep`` and delete the folders none of the
        kept ones reads.  Returns the deleted versions.

        Commits are marked expired before any folder goes, so a crash midway
        leaves only unreferenced folders, removed by the next run.
        """
        logged = self._all_commits().select("version")
        live = live_versions(logged, keep)
        dead = [row["version"] for row in logged.join(live, "version", "left_anti").collect()]
        gone = self.commits().join(keep.select("version"), "version", "left_anti").select("version")
        gone.coalesce(1).write.mode("append").parquet(f"{self.path}/expired")
        removed = [v for v in sorted(dead) if delete_path(self.spark, f"{self.path}/data/_version={v}")]
        return self.spark.createDataFrame([(v,) for v in removed], VERSION_ONLY)

    def _all_commits(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/commits", COMMITS)

    # -- internals -------------------------------------------------------

    def _state(self, batch_id: str | None) -> tuple[Row | None, Row | None]:
        """The newest commit, and the one that already holds ``batch_id``."""
        commit = F.struct(*COMMITS.fieldNames())
        same = F.col("batch_id") == F.lit(batch_id)
        found = self._all_commits().agg(
            F.max_by(commit, "version").alias("last"),
            F.max_by(F.when(same, commit), F.when(same, F.col("version"))).alias("done"),
        )
        return tuple(found.first())

    def _write(
        self,
        df: DataFrame,
        version: int,
        drop: Sequence[str] = (),
        shape: Callable[[DataFrame], DataFrame] | None = None,
        **counts: Column,
    ) -> Callable[..., int]:
        """Write one version's folder; rows are counted in the writing stage, so
        repeated tasks of earlier stages do not count."""
        watched, read_counts = observed((shape or self._shape)(df), **counts)
        written = watched.drop(*drop)
        if self.sort_cols:
            written = written.sortWithinPartitions(*self.sort_cols)
        written.write.mode("overwrite").partitionBy(*self._folders()).parquet(
            f"{self.path}/data/_version={version}"
        )
        return read_counts

    def _shape(self, df: DataFrame) -> DataFrame:
        return df

    def _folders(self) -> tuple[str, ...]:
        return self.partition_cols

    def _bucket_count(self) -> int | None:
        return None

    def _commit(
        self,
        version: int,
        base: int,
        operation: str,
        batch_id: str | None,
        committed_at: Moment,
        schema: T.StructType,
        rows_added: int,
        rows_removed: int | None = None,
        current_base: int | None = None,
        buckets: Sequence[int] | None = None,
        marks: dict[str, str] | None = None,
    ) -> Row:
        batch = batch_id or str(uuid.uuid4())
        digest = hashlib.sha256(f"{batch}/{version}".encode()).digest()
        values = {
            "version": version,
            "base": base,
            "current_base": current_base,
            "snapshot_id": int.from_bytes(digest[:8], "big") >> 1,
            "batch_id": batch,
            "committed_at": self._instant(committed_at),
            "operation": operation,
            "rows_added": rows_added,
            "rows_removed": rows_removed or 0,
            "schema_json": schema.json(),
            "buckets": None if buckets is None else list(buckets),
            "n_buckets": self._bucket_count(),
            "marks": marks,
        }
        row = Row(**values)
        logged = self.spark.createDataFrame([tuple(row)], COMMITS)
        logged.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return row

    def _instant(self, at: Moment) -> datetime:
        """A commit time as a plain UTC value."""
        if at is None:
            return datetime.now(UTC).replace(tzinfo=None)
        if isinstance(at, Column):
            return self.spark.range(1).select(at).first()[0]
        return datetime.fromisoformat(str(at))


def carried(last: Row | None, marks: dict[str, str] | None = None) -> dict[str, str] | None:
    """The marks of the last commit and new ones."""
    return {**((last["marks"] or {}) if last is not None else {}), **(marks or {})} or None


def _kind(df: DataFrame, col: str | None) -> T.DataType | None:
    return None if col is None else df.schema[col].dataType


def _watched_mark(col: str | None) -> dict[str, Column]:
    return {} if col is None else {"mark": F.max(col).cast("string")}


def _marks(last: Row | None, counts: Callable[..., Any], col: str | None, kind: T.DataType | None) -> dict[str, str] | None:
    """Marks of a commit: those of the last one, the column's own not below it.

    Numbers are compared as numbers, other values as text, the order of which
    is that of dates and stamps.
    """
    marks = dict((last["marks"] or {}) if last is not None else {})
    found = None if col is None else counts("mark")
    if found is not None:
        order = Decimal if isinstance(kind, T.NumericType) else str
        marks[col] = max(found, marks.get(col, found), key=order)
    return marks or None


def latest_commit(commits: DataFrame) -> DataFrame:
    """Newest entry of a commit history."""
    return commits.orderBy(F.col("version").desc()).limit(1)


def keep_last(commits: DataFrame, retain_last: int) -> DataFrame:
    """The newest ``retain_last`` commits (at least one)."""
    return commits.orderBy(F.col("version").desc()).limit(max(retain_last, 1))


def keep_younger_than(commits: DataFrame, retain_hours: int, now: Moment = None) -> DataFrame:
    """Commits no older than ``retain_hours``; the newest one always stays."""
    oldest = moment(now) - F.make_dt_interval(hours=F.lit(retain_hours))
    newest = commits.agg(F.max("version")).scalar()
    return commits.filter((F.col("committed_at") >= oldest) | (F.col("version") == newest))


def live_versions(commits: DataFrame, keep: DataFrame) -> DataFrame:
    """Versions whose folder some kept commit reads, among all ever committed.

    A version is read if a kept commit at or after it begins at or before it:
    one pass over the commits, newest first, with the smallest ``base`` so far.
    """
    starts = commits.select("version").join(keep.select("version", "base"), "version", "left")
    later = Window.orderBy(F.col("version").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return starts.withColumn("first", F.min("base").over(later)).filter("first <= version").select("version")


def stored_schema(commit: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit["schema_json"]))


def next_version(last: Row | None) -> int:
    return 0 if last is None else last["version"] + 1


def evolved(old: T.StructType, new: T.StructType, keep_missing: bool) -> T.StructType:
    """Schema after a batch of shape ``new``: its columns, then, if kept, the
    older ones it lacks.

    Stored files are not rewritten, so a column cannot change its type here.
    """
    retyped = schema_changes(old, new)["retyped"]
    if retyped:
        raise ValueError(f"columns change type: {retyped}; overwrite the table to retype them")
    if not keep_missing:
        return new
    return T.StructType([*new.fields, *[f for f in old if f.name not in new.fieldNames()]])
