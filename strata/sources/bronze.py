"""Bronze writers and readers: append-only, partitioned by arrival."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.ingest import with_ingest_metadata
from strata.functions.stamps import Moment, epoch_micros, from_epoch_seconds, moment
from strata.operators.metrics import observed
from strata.session import create_file, delete_path, path_exists

HIDDEN_DAY = "_day"
LEDGER = "_batches"


def append(
    df: DataFrame,
    path: str,
    source: str,
    batch_id: str | None = None,
    as_of: Moment = None,
    partition_cols: Sequence[str] = ("_ingestion_date",),
    sort_cols: Sequence[str] = (),
    even_files: bool = False,
) -> int:
    """Enrich and append a batch; returns the rows written, counted on the way.

    ``even_files`` lets AQE rebalance the rows to its advisory partition size,
    splitting skewed partitions, so a batch does not leave many small files.
    A batch id that is stored already is not written again: a ledger beside the
    data has one small file per batch, so a replay looks for one file and reads
    no data.  A batch that an earlier run began and did not finish is removed
    first and written whole.
    """
    enriched = with_ingest_metadata(df, source, batch_id, as_of)
    if batch_id is None:
        return _write(enriched, path, partition_cols, sort_cols, even_files)
    ledger = BatchLedger(df.sparkSession, path)
    if ledger.done(batch_id):
        return 0
    ledger.begin(batch_id)
    written = _write(enriched, path, partition_cols, sort_cols, even_files)
    ledger.finish(batch_id)
    return written


@dataclass(frozen=True)
class BatchLedger:
    """Which batches a bronze folder holds, one hidden file each, by a hash of the id."""

    spark: SparkSession
    path: str

    def done(self, batch_id: str) -> bool:
        """Whether the batch is stored; data from before there was a ledger is searched."""
        if path_exists(self.spark, self._file("done", batch_id)):
            return True
        if path_exists(self.spark, self._file("begun", batch_id)):
            return False
        root = f"{self.path}/{LEDGER}"
        older = path_exists(self.spark, f"{root}/older") or not path_exists(self.spark, root)
        return older and path_exists(self.spark, self.path) and bool(self._files_of(batch_id))

    def begin(self, batch_id: str) -> None:
        """Note the batch; if it was noted before, remove what it left."""
        if path_exists(self.spark, self._file("begun", batch_id)):
            for file in self._files_of(batch_id):
                delete_path(self.spark, file)
            return
        if path_exists(self.spark, self.path) and not path_exists(self.spark, f"{self.path}/{LEDGER}"):
            create_file(self.spark, f"{self.path}/{LEDGER}/older")
        create_file(self.spark, self._file("begun", batch_id))

    def finish(self, batch_id: str) -> None:
        create_file(self.spark, self._file("done", batch_id))

    def _file(self, state: str, batch_id: str) -> str:
        return f"{self.path}/{LEDGER}/{state}-{hashlib.sha256(batch_id.encode()).hexdigest()}"

    def _files_of(self, batch_id: str) -> list[str]:
        """Data files of one batch; an append leaves no file with rows of two."""
        try:
            stored = self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # nothing was written yet
                return []
            raise
        if "_batch_id" not in stored.columns:
            return []
        of_batch = stored.filter(F.col("_batch_id") == batch_id).select("_metadata.file_path").distinct()
        return [unquote(row[0]) for row in of_batch.collect()]


def append_by_day(
    df: DataFrame, path: str, ts_col: str = "_ingestion_ts", sort_cols: Sequence[str] = ()
) -> int:
    """Append under a day partition derived from ``ts_col``.

    The partition column is hidden: readers never see it and filter on
    ``ts_col`` (:func:`read_days`).
    """
    return _write(df.withColumn(HIDDEN_DAY, F.to_date(ts_col)), path, [HIDDEN_DAY], sort_cols, True)


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A bronze table.  A declared schema avoids reading file footers; without
    one the schemas of all files are merged."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_days(
    spark: SparkSession, path: str, ts_col: str, start: Moment, end: Moment, schema: T.StructType | None = None
) -> DataFrame:
    """Rows with ``start <= ts_col < end``; the range also prunes the hidden days."""
    first, last = moment(start), moment(end)
    rows = read(spark, path, schema)
    pruned = rows.filter(F.col(HIDDEN_DAY).between(F.to_date(first), F.to_date(last)))
    return pruned.filter((F.col(ts_col) >= first) & (F.col(ts_col) < last)).drop(HIDDEN_DAY)


def land_json(df: DataFrame, path: str, ts_col: str = "_ingestion_ts") -> int:
    """Raw landing as JSON lines under year, month, day and hour folders; the
    arrival time is kept as epoch seconds."""
    stamp = F.col(ts_col)
    parts = {"y": "yyyy", "m": "MM", "d": "dd", "h": "HH"}
    rows = df.withColumns({name: F.date_format(stamp, fmt) for name, fmt in parts.items()})
    seconds = epoch_micros(stamp) / F.lit(1_000_000)
    watched, counts = observed(rows.withColumn(ts_col, seconds))
    watched.write.mode("append").partitionBy(*parts).json(path)
    return counts()


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, ts_col: str = "_ingestion_ts"
) -> DataFrame:
    """Landed records in ``schema``, the arrival time back as a timestamp."""
    landed = T.StructType(
        [T.StructField(f.name, T.DoubleType() if f.name == ts_col else f.dataType) for f in schema]
    )
    rows = spark.read.schema(landed).json(path)
    return rows.withColumn(ts_col, from_epoch_seconds(F.col(ts_col))).select(*schema.fieldNames())


def _write(
    df: DataFrame, path: str, partition_cols: Sequence[str], sort_cols: Sequence[str], even_files: bool
) -> int:
    shaped = df.hint("rebalance", *[F.col(c) for c in partition_cols]) if even_files else df
    watched, counts = observed(shaped)
    if sort_cols:
        watched = watched.sortWithinPartitions(*partition_cols, *sort_cols)
    watched.write.mode("append").partitionBy(*partition_cols).parquet(path)
    return counts()
