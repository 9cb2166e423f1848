"""Catalog crawl, table documents and the searchable index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.merge import upsert
from strata.operators.vectors import TOP_K, text_vectorizer, text_vectors, vector_topk
from strata.session import settle, struct

SYSTEM_SCHEMAS = ("information_schema", "system")
MAX_LISTED = 50
#: Characters of a sample value that a document shows.
SHOWN = 40

TABLES = struct(
    catalog=T.StringType(), schema=T.StringType(), table_name=T.StringType(), description=T.StringType()
)
COLUMNS = struct(
    catalog=T.StringType(),
    schema=T.StringType(),
    table_name=T.StringType(),
    position=T.IntegerType(),
    name=T.StringType(),
    type=T.StringType(),
    description=T.StringType(),
)
TABLE_KEY = ["catalog", "schema", "table_name"]


def full_name() -> Column:
    return F.concat_ws(".", *TABLE_KEY)


def crawl(
    spark: SparkSession, catalogs: Sequence[str] | None = None, schemas: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(tables, columns)`` of the named catalogs (the current one if none is
    named), system schemas left out.

    A catalog that cannot be read is an error that names it.  Only names and
    types pass through the driver, which holds them anyway.
    """
    current = spark.catalog.currentCatalog()
    found_tables, found_columns = [], []
    try:
        for catalog in catalogs or [current]:
            spark.catalog.setCurrentCatalog(catalog)
            for database in spark.catalog.listDatabases():
                if database.name in SYSTEM_SCHEMAS or (schemas and database.name not in schemas):
                    continue
                for table in spark.catalog.listTables(f"`{catalog}`.`{database.name}`"):
                    if table.isTemporary:
                        continue
                    found_tables.append((catalog, database.name, table.name, table.description))
                    described = spark.catalog.listColumns(f"`{catalog}`.`{database.name}`.`{table.name}`")
                    found_columns += [
                        (catalog, database.name, table.name, i, c.name, c.dataType, c.description)
                        for i, c in enumerate(described)
                    ]
    finally:
        spark.catalog.setCurrentCatalog(current)
    return spark.createDataFrame(found_tables, TABLES), spark.createDataFrame(found_columns, COLUMNS)


def describe_frames(
    spark: SparkSession, frames: Mapping[str, DataFrame], catalog: str = "spark", schema: str = "main"
) -> tuple[DataFrame, DataFrame]:
    """``(tables, columns)`` of named frames, in the shape of :func:`crawl`."""
    tables = [(catalog, schema, name, "") for name in frames]
    columns = [
        (catalog, schema, name, i, f.name, f.dataType.simpleString(), "")
        for name, df in frames.items()
        for i, f in enumerate(df.schema)
    ]
    return spark.createDataFrame(tables, TABLES), spark.createDataFrame(columns, COLUMNS)


def visible_tables(
    tables: DataFrame, catalogs: Sequence[str] | None = None, schemas: Sequence[str] | None = None
) -> DataFrame:
    """Rows outside the system schemas, in the named catalogs if any are named."""
    kept = tables.filter(~F.col("schema").isin(*SYSTEM_SCHEMAS))
    if catalogs:
        kept = kept.filter(F.col("catalog").isin(*catalogs))
    if schemas:
        kept = kept.filter(F.col("schema").isin(*schemas))
    return kept


def list_tables(tables: DataFrame, limit: int = MAX_LISTED) -> DataFrame:
    """Full names in order, at most ``limit``."""
    return tables.select(full_name().alias("full_name")).orderBy("full_name").limit(limit)


def profile(df: DataFrame, samples: int = 3) -> dict[str, object]:
    """Row count and the smallest distinct values of each orderable column.

    One scan per sample, for any number of columns: the next value is the
    smallest above the last, which is kept in a stored table of one row.
    Nothing is shuffled but one row per task; the values themselves, texts cut
    to ``SHOWN`` characters, are all that comes to the driver.
    """
    columns = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    rows: int | None = None
    above: dict[str, Column] = {}
    found: dict[str, list] = {c: [] for c in columns}
    for _ in range(samples):
        nexts = [F.min(F.when(above[c], F.col(c)) if c in above else F.col(c)).alias(c) for c in columns]
        smallest = settle(df.agg(F.count(F.lit(1)).alias("_rows"), *nexts), "profile")
        shown = [F.substring(F.col(c).cast("string"), 1, SHOWN).alias(c) for c in columns]
        row = smallest.select("_rows", *shown).first()
        rows = row["_rows"] if rows is None else rows
        for c in columns:
            if row[c] is not None:
                found[c].append(row[c])
        above = {c: F.col(c) > smallest.select(c).scalar() for c in columns}
    return {"row_count": rows, "samples": {c: v for c, v in found.items() if v}}


def profiles(spark: SparkSession, frames: Mapping[str, DataFrame], samples: int = 3) -> tuple[DataFrame, DataFrame]:
    """``(row counts, sample values)`` of named frames."""
    done = {name: profile(df, samples) for name, df in frames.items()}
    counts = [(name, p["row_count"]) for name, p in done.items()]
    values = [(name, c, v) for name, p in done.items() for c, v in p["samples"].items()]
    return (
        spark.createDataFrame(counts, struct(table_name=T.StringType(), row_count=T.LongType())),
        spark.createDataFrame(
            values,
            struct(table_name=T.StringType(), name=T.StringType(), samples=T.ArrayType(T.StringType())),
        ),
    )


def documents(
    tables: DataFrame,
    columns: DataFrame,
    counts: DataFrame | None = None,
    samples: DataFrame | None = None,
) -> DataFrame:
    """One text per table, ``(full_name, catalog, document)``.

    Tables meet their columns in one join; each table's columns are gathered
    in order (a table has few columns).
    """
    line = F.concat_ws(" ", F.lit("*"), "name", "type", F.concat(F.lit("-- "), F.nullif("description", F.lit(""))))
    lines = columns.select(*TABLE_KEY, "position", "name", line.alias("line"))
    if samples is not None:
        lines = lines.join(samples.select("table_name", "name", "samples"), ["table_name", "name"], "left")
    else:
        lines = lines.withColumn("samples", F.lit(None).cast("array<string>"))
    seen = F.concat(F.lit(" e.g. "), F.array_join(F.slice("samples", 1, 3), " / "))
    gathered = lines.groupBy(*TABLE_KEY).agg(
        F.sort_array(F.collect_list(F.struct("position", F.concat("line", F.coalesce(seen, F.lit(""))).alias("line")))).alias(
            "cols"
        )
    )
    described = tables.join(gathered, TABLE_KEY, "left")
    if counts is not None:
        described = described.join(counts, "table_name", "left")
    else:
        described = described.withColumn("row_count", F.lit(None).cast("long"))
    head = F.concat_ws(
        " ", full_name(), F.concat(F.lit("holds "), F.col("row_count").cast("string"), F.lit(" rows"))
    )
    text = F.concat_ws("\n", head, F.nullif("description", F.lit("")), F.array_join(F.col("cols.line"), "\n"))
    return described.select(full_name().alias("full_name"), "catalog", text.alias("document"))


def index_upsert(index: DataFrame, docs: DataFrame) -> DataFrame:
    """The index after (re-)indexing ``docs``, keyed by full name."""
    return upsert(index, docs, ["full_name"])


def save_index(docs: DataFrame, path: str) -> None:
    """Fit the text features on table documents and store them with the documents' vectors."""
    model = text_vectorizer(docs)
    model.write().overwrite().save(f"{path}/features")
    text_vectors(docs, model).write.mode("overwrite").parquet(f"{path}/documents")


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, PipelineModel]:
    """A stored index and the features that questions need."""
    return spark.read.parquet(f"{path}/documents"), PipelineModel.load(f"{path}/features")


def upsert_index(path: str, docs: DataFrame) -> None:
    """(Re-)index some documents of a stored index, with the features it has."""
    index, model = load_index(docs.sparkSession, path)
    merged = index_upsert(index, text_vectors(docs, model).select(*index.columns))
    settle(merged, "index").write.mode("overwrite").parquet(f"{path}/documents")


def search(index: DataFrame, model: PipelineModel, question: str, k: int = TOP_K) -> DataFrame:
    """The ``k`` indexed documents most similar to a question.

    ``index`` holds the vectors of :func:`strata.operators.vectors.text_vectors`
    under ``embedding``.
    """
    asked = index.sparkSession.createDataFrame([(question,)], struct(document=T.StringType()))
    vector = text_vectors(asked, model).first()["embedding"]
    return vector_topk(index, vector, k, id_col="full_name")
