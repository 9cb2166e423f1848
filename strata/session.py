"""Session helpers: a tuned local session, scratch folders and scans."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_scratch: dict[str, str] = {}
_scopes = threading.local()
_shipped: set[str] = set()


def local_session(cpus: int = 8, app_name: str = "strata") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.conf.get("spark.app.id", "local")
        base = _local_scratch.setdefault(app, "") or tempfile.mkdtemp(prefix="strata-")
        _local_scratch[app] = base
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    for made in getattr(_scopes, "open", [])[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made in the block are deleted when it ends without an error.

    For work that has stored its result elsewhere by then: frames that still
    read such a folder cannot be used afterwards.  Scopes nest, and each thread
    has its own.
    """
    stack = _scopes.__dict__.setdefault("open", [])
    stack.append([])
    try:
        yield
    except BaseException:
        stack.pop()
        raise
    for path in stack.pop():
        delete_path(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Needed for the Python data source where the package is not installed there
    (``spark-submit --py-files`` does the same).
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='strata-')}/{package.name}", "zip", package.parent, package.name
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def settle(df: DataFrame, label: str = "settled", partition_cols: list[str] | None = None) -> DataFrame:
    """Write a frame to scratch and read it back.

    Cuts lineage in a way that survives lost executors, lets several branches
    share one computation, and gives the optimizer the real byte size.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.partitionBy(*(partition_cols or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Scan ``path`` with a declared schema; an absent path is an empty table."""
    if path_exists(spark, path):
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove one folder through the Hadoop file system (any store Spark can write)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, by one listing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return []
    return [s.getPath().getName() for s in store.listStatus(target) if s.isDirectory()]


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, through the Hadoop file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True).close()


def struct(**fields: T.DataType) -> T.StructType:
    """A schema from keyword arguments; needs no running session."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
