"""Bin packing of small Parquet files, in place and file by file.

Small files of a folder tree are chosen from its listing and packed, partition
by partition, into groups of about the target size.  Only the files of a group
are read and only its new file is written; every other file keeps its name.

New files are staged in a hidden folder.  A journal that names what moves in and
what goes is written before the first file moves, so a run that dies midway is
finished by the next (:func:`recover`).  Between its moves and its deletions a
reader may see rows twice; whoever needs isolation reads versioned tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import delete_path, path_exists, struct

#: Files below this share of the target size are small.  Groups then exceed it,
#: so what was packed is not packed again.
SMALL_SHARE = 0.5
#: Files that one round reads; bounds the lists on the driver.
ROUND_FILES = 5_000
STAGING = "_packing"
JOURNAL = struct(staged=T.StringType(), moves=T.ArrayType(T.ArrayType(T.StringType())), gone=T.ArrayType(T.StringType()))


def packing_plan(
    files: DataFrame, partition_cols: Sequence[str], target_bytes: int, min_input_files: int
) -> DataFrame:
    """``path``, ``length``, the partition columns and ``group``: the small files worth packing.

    Files follow each other by size; a group ends where the running sum of
    their sizes passes a multiple of the target, so it holds between half and
    one and a half times of it, the last one less.  Groups of one file are left
    alone, and so are partitions with fewer than ``min_input_files`` small ones.
    """
    small = files.filter(F.col("length") < F.lit(SMALL_SHARE * target_bytes))
    of_partition = Window.partitionBy(*partition_cols)
    end = F.sum("length").over(of_partition.orderBy("length", "path"))
    placed = small.select(
        "*", F.floor((end - 1) / F.lit(target_bytes)).alias("group"), F.count(F.lit(1)).over(of_partition).alias("_small")
    ).filter(F.col("_small") >= min_input_files)
    together = F.count(F.lit(1)).over(Window.partitionBy(*partition_cols, "group"))
    return placed.withColumn("_together", together).filter("_together > 1").drop("_small", "_together")


def pack_files(
    spark: SparkSession,
    path: str,
    files: DataFrame,
    partition_cols: Sequence[str] = (),
    target_bytes: int = 128 * 1024 * 1024,
    min_input_files: int = 5,
) -> dict[str, int]:
    """Pack the small files among ``files``, the listing of ``path``.

    The listing has ``path``, ``length`` and the partition columns as text.
    Returns how many partitions, files read and files written there were.
    """
    recover(spark, path)
    plan = packing_plan(files, partition_cols, target_bytes, min_input_files)
    done = {"partitions": 0, "files_read": 0, "files_written": 0}
    last = None
    for rows in _rounds(plan.orderBy(*partition_cols, "group").toLocalIterator()):
        _pack_round(spark, path, rows, partition_cols)
        groups = [(*[r[c] for c in partition_cols], r["group"]) for r in rows]
        places = [g[:-1] for g in dict.fromkeys(groups)]
        done["files_read"] += len(rows)
        done["files_written"] += len(places)
        done["partitions"] += len({*places} - {last})
        last = places[-1]
    if done["files_read"]:
        spark.catalog.refreshByPath(path)
    return done


def _rounds(rows: Iterator[Row]) -> Iterator[list[Row]]:
    """Whole groups, up to ``ROUND_FILES`` files at a time."""
    held: list[Row] = []
    group: list[Row] = []
    for row in rows:
        if group and tuple(row)[2:] != tuple(group[0])[2:]:
            held, group = held + group, []
            if len(held) >= ROUND_FILES:
                yield held
                held = []
        group.append(row)
    if held or group:
        yield held + group


def _pack_round(spark: SparkSession, path: str, rows: list[Row], partition_cols: Sequence[str]) -> None:
    """Read the files of some groups, stage one file per group, and swap."""
    fields = [T.StructField(c, T.StringType()) for c in partition_cols]
    names = [r["path"] for r in rows]
    # only these files' footers are read for the merged schema
    stored = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*names).schema
    schema = T.StructType([*[f for f in stored if f.name not in partition_cols], *fields])
    groups = {g: i for i, g in enumerate(dict.fromkeys((*[r[c] for c in partition_cols], r["group"]) for r in rows))}
    # a job's tasks give their files the same names in every partition
    of = spark.createDataFrame(
        [
            (r["path"].rpartition("/")[2], *[r[c] for c in partition_cols], groups[(*[r[c] for c in partition_cols], r["group"])])
            for r in rows
        ],
        T.StructType([T.StructField("_file", T.StringType()), *fields, T.StructField("_group", T.IntegerType())]),
    )
    read = spark.read.schema(schema).option("basePath", path).parquet(*names)
    content = read.select(*schema.fieldNames(), F.col("_metadata.file_name").alias("_from"))
    same = [content[c].eqNullSafe(of[c]) for c in partition_cols] + [content["_from"] == of["_file"]]
    grouped = content.join(F.broadcast(of), same, "inner")  # ROUND_FILES rows and the rest of a group
    shaped = grouped.select(*[content[c] for c in schema.fieldNames()], "_group").repartitionById(
        len(groups), F.col("_group")
    )
    staged = f"{path.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
    shaped.drop("_group").write.partitionBy(*partition_cols).parquet(staged)
    moves = [[new, f"{path.rstrip('/')}/{new[len(staged) + 1 :]}"] for new in _data_files(spark, staged)]
    journal = spark.createDataFrame([(staged, moves, names)], JOURNAL)
    journal.coalesce(1).write.json(f"{staged}-journal")
    _finish(spark, path, f"{staged}-journal")


def recover(spark: SparkSession, path: str) -> int:
    """Finish the swaps that an earlier run began; staged files of one that did not are removed."""
    root = f"{path.rstrip('/')}/{STAGING}"
    if not path_exists(spark, root):
        return 0
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    store = jvm_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    begun = [s.getPath().toString() for s in store.listStatus(jvm_path(root))]
    journals = [p for p in begun if p.endswith("-journal") and path_exists(spark, f"{p}/_SUCCESS")]
    for journal in journals:
        _finish(spark, path, journal)
    delete_path(spark, root)
    return len(journals)


def _finish(spark: SparkSession, path: str, journal: str) -> None:
    """Move new files in, delete old ones, forget the journal; repeatable at any point."""
    entry = spark.read.schema(JOURNAL).json(journal).first()
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    store = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for source, target in entry["moves"]:
        if store.exists(jvm_path(source)):
            store.mkdirs(jvm_path(target).getParent())
            if not store.rename(jvm_path(source), jvm_path(target)):
                raise OSError(f"cannot move {source} to {target}")
    for old in entry["gone"]:
        store.delete(jvm_path(old), False)
    delete_path(spark, entry["staged"])
    delete_path(spark, journal)


def _data_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a folder, in the folder's own notation."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    root = jvm_path(folder)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = store.getFileStatus(root).getPath().toString()
    found, walk = [], store.listFiles(root, True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if name.endswith(".parquet"):
            found.append(folder + name[len(base) :])
    return sorted(found)
