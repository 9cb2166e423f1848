"""Apply a change feed to a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_latest

DELETE_OPS = ("d", "delete")


def cdc_apply(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    op_col: str = "op",
    order_col: str = "change_ts",
) -> DataFrame:
    """Table after the newest change of each key: a delete removes the row,
    anything else replaces or adds it."""
    newest = dedupe_latest(changes, keys, order_col)
    survivors = newest.filter(~F.lower(F.col(op_col)).isin(*DELETE_OPS)).select(*target.columns)
    untouched = target.join(newest.select(*keys), [*keys], "left_anti")
    return untouched.unionByName(survivors)
