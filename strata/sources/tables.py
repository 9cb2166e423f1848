"""Scans of stored tables, SQL views and cross-format reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.tables import database_name

MAX_ROWS = 100


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Expose frames to SQL text by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register stored files as a table of the catalog; the files stay where they
    are.  A known external table is registered anew; a managed table of that
    name is refused, since dropping it would delete its files."""
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"{name} is a managed table")
        spark.sql(f"DROP TABLE {name}")
    return spark.catalog.createTable(name, path=path, source=fmt)


def source_table(spark: SparkSession, schema: str | None, table: str, default: str = "default") -> DataFrame:
    """A table of the catalog by schema and name."""
    return spark.table(f"`{database_name(schema, default)}`.`{table}`")


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """The frame of one SQL statement, as typed: blanks and a trailing semicolon
    are dropped."""
    return spark.sql(sql.strip().rstrip(";"))


def capped_query(spark: SparkSession, sql: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` rows of a query, for display."""
    return run_query(spark, sql).limit(max_rows)


def page_of(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The first ``max_rows`` rows of an ordered result, each with the full
    ``row_count``."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.limit(max_rows).withColumn("row_count", total)
