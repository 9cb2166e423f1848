"""Schema evolution between a stored table and an arriving batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_changes(stored: T.StructType, incoming: T.StructType) -> dict[str, list[str]]:
    """Column names added, dropped and retyped by ``incoming``."""
    old = {f.name: f.dataType for f in stored}
    new = {f.name: f.dataType for f in incoming}
    return {
        "added": [c for c in new if c not in old],
        "dropped": [c for c in old if c not in new],
        "retyped": [c for c in new if c in old and old[c] != new[c]],
    }


def sync_append(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Append with all columns synchronised to the batch.

    New columns are null in old rows; columns the batch lacks leave the current
    schema (older versions of the table keep them); a retyped column is cast.
    """
    retyped = schema_changes(stored.schema, batch.schema)["retyped"]
    aligned = stored.withColumns({c: F.col(c).cast(batch.schema[c].dataType) for c in retyped})
    return aligned.unionByName(batch, allowMissingColumns=True).select(*batch.columns)


def conform(df: DataFrame, schema: T.StructType, drop_unknown: bool = False) -> DataFrame:
    """``df`` in the shape of a declared schema: cast, ordered, gaps null.

    A column the schema does not know is an error unless it may be dropped.
    """
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown and not drop_unknown:
        raise ValueError(f"columns not in the declared schema: {unknown}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
