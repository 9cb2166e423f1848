"""Gold tables: full refresh, incremental append, stored-query refresh."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.stamps import Moment
from strata.operators.incremental import newer_than, newer_than_value
from strata.sources.tables import run_query
from strata.sources.versions import SETTLED, VersionedTable

HIDDEN_PARTITION = "_partition"
#: True for rows of an incremental table that the next run takes anew.
OPEN = "_is_current"


DEFINITION = "name STRING, query STRING, partition_by STRING, cluster_by ARRAY<STRING>"


@dataclass
class GoldStore:
    """Gold tables under one root, built from SQL over registered views.

    Every build is a new version, so readers of the old one are not disturbed.
    The query that made a table is stored beside it, so any session can refresh
    the table by name.
    """

    spark: SparkSession
    root: str

    def build(
        self,
        name: str,
        query: str,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        committed_at: Moment = None,
    ) -> int:
        """Replace the table by the query's result; returns the rows written.

        ``partition_by`` is a column of the result or an expression over it
        such as ``year(day)``.
        """
        written = self.write(name, run_query(self.spark, query), partition_by, cluster_by, committed_at)
        self._define(name, query, partition_by, cluster_by)
        return written

    def build_incremental(
        self,
        name: str,
        query: str,
        watermark_col: str,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        committed_at: Moment = None,
        lookback: str | None = None,
    ) -> int:
        """Append the rows past the table's own mark (everything on a first run).

        The mark is kept with each write, so no stored column is read for it
        (a table that was made by ``build`` is asked once).

        Without ``lookback`` rows that come late, or with a null mark, are not
        taken after the first run.  With it (an interval such as ``'2 days'``)
        the rows within that distance of the mark and those without one stay
        open: each run takes them anew from the query, late ones included, and
        settles what has become older; settled rows are not touched again.
        Returns the rows written.
        """
        rows = run_query(self.spark, query)
        if lookback is not None:
            written = self._build_open(name, rows, watermark_col, partition_by, cluster_by, committed_at, lookback)
        else:
            table = self.table(name, rows, partition_by, cluster_by)
            if table.latest() is not None:
                mark = table.mark(watermark_col)
                if mark is None:
                    rows = newer_than(rows, watermark_col, table.current())
                else:
                    rows = newer_than_value(rows, watermark_col, mark)
            shaped = _shaped(rows, partition_by)
            written = table.append(shaped, committed_at=committed_at, mark_col=watermark_col)["rows_added"]
        self._define(name, query, partition_by, cluster_by)
        return written

    def _build_open(
        self,
        name: str,
        rows: DataFrame,
        col: str,
        partition_by: str | None,
        cluster_by: Sequence[str],
        committed_at: Moment,
        lookback: str,
    ) -> int:
        if OPEN in rows.columns:
            raise ValueError(f"{name}: {OPEN} marks open rows and cannot be a column of the query")
        table = self.table(name, rows, partition_by, cluster_by)
        table = replace(table, partition_cols=(OPEN, *table.partition_cols))
        last = table.latest()
        if last is not None and last["current_base"] is None:
            raise ValueError(f"{name} was built without lookback; build it again to change that")
        kind = rows.schema[col].dataType
        marks = (last["marks"] or {}) if last is not None else {}
        mark = marks.get(col)
        if mark is None:  # a first run: the newest value of the query itself
            mark = rows.agg(F.max(col).cast("string")).first()[0]
        settled_to = None
        if mark is not None:
            end = F.lit(mark).cast(kind) - F.expr(f"interval {lookback}")
            settled_to = self.spark.range(1).select(end.cast(kind).cast("string")).first()[0]
        from_ = marks.get(f"{SETTLED}{col}")
        if from_ is not None:
            rows = rows.filter((F.col(col) > F.lit(from_).cast(kind)) | F.col(col).isNull())
        still = F.coalesce(F.col(col) > F.lit(settled_to).cast(kind), F.lit(True))
        shaped = _shaped(rows.withColumn(OPEN, still), partition_by)
        return table.replace_open(shaped, col, settled_to, committed_at=committed_at)["rows_added"]

    def refresh(self, name: str, committed_at: Moment = None) -> int:
        """Rerun the stored query of a table."""
        stored = self.spark.read.schema(DEFINITION).json(self._definition(name)).first()
        if stored is None:
            raise KeyError(name)
        return self.build(name, stored["query"], stored["partition_by"], stored["cluster_by"] or (), committed_at)

    def _define(self, name: str, query: str, partition_by: str | None, cluster_by: Sequence[str]) -> None:
        row = self.spark.createDataFrame([(name, query, partition_by, [*cluster_by])], DEFINITION)
        row.coalesce(1).write.mode("overwrite").json(self._definition(name))

    def _definition(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_definitions/{name}"

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        committed_at: Moment = None,
    ) -> int:
        """Replace a table by a frame, for models written as DataFrames."""
        table = self.table(name, df, partition_by, cluster_by)
        shaped = _shaped(df, partition_by)
        return table.overwrite(shaped, "build", committed_at=committed_at)["rows_added"]

    def read(self, name: str) -> DataFrame:
        stored = VersionedTable(self.spark, self._path(name))
        last = stored.latest()
        hidden = [HIDDEN_PARTITION, OPEN] if last is not None and last["current_base"] is not None else [HIDDEN_PARTITION]
        return stored.current().drop(*hidden)

    def table(
        self,
        name: str,
        df: DataFrame,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
    ) -> VersionedTable:
        partitions = _partitions(df, partition_by)
        return VersionedTable(self.spark, self._path(name), partitions, (*partitions, *cluster_by))

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _partitions(df: DataFrame, partition_by: str | None) -> tuple[str, ...]:
    if partition_by is None:
        return ()
    return (partition_by,) if partition_by in df.columns else (HIDDEN_PARTITION,)


def _shaped(df: DataFrame, partition_by: str | None) -> DataFrame:
    """Add the hidden partition column of an expression and bring each
    partition's rows together; AQE splits the large ones."""
    if partition_by is None:
        return df
    if partition_by not in df.columns:
        df = df.withColumn(HIDDEN_PARTITION, F.expr(partition_by))
    return df.hint("rebalance", *_partitions(df, partition_by))
