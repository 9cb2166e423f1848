"""Row fingerprints for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"


def business_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Every column that is not a system column (leading underscore)."""
    return [c for c in df.columns if not c.startswith("_") and c not in exclude]


def row_hash(cols: Sequence[str], style: str = "null_as_empty") -> Column:
    """Fingerprint of ``cols`` in the given order.

    ``null_as_empty``  SHA-256, nulls keep their place: (a, null, b) != (a, b).
    ``skip_nulls``     SHA-256, nulls vanish from the joined text.
    ``json_md5``       MD5 of the JSON object of the columns.
    """
    if style == "null_as_empty":
        text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
        return F.sha2(F.concat_ws(SEPARATOR, *text), 256)
    if style == "skip_nulls":
        return F.sha2(F.concat_ws(SEPARATOR, *[F.col(c).cast("string") for c in cols]), 256)
    if style == "json_md5":
        return F.md5(F.to_json(F.struct(*[F.col(c) for c in cols])))
    raise ValueError(f"unknown hash style {style!r}")
