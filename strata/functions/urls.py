"""Cursor parameters from a next-page link."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def query_params(url: Column) -> Column:
    """Query string of ``url`` as a map, first value per key, percent-decoded.

    Pairs without a value are skipped.  Everything is an array expression, so
    the work stays in the scan's stage.
    """
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]+=.+"))
    parts = F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.regexp_extract(p, "^[^=]+=(.*)$", 1)).alias("v"),
        ),
    )
    names = F.array_distinct(F.transform(parts, lambda x: x["k"]))
    first = F.transform(
        names,
        lambda n: F.element_at(F.filter(parts, lambda x: x["k"] == n), 1)["v"],
    )
    return F.map_from_arrays(names, first)


def _decode(text: Column) -> Column:
    return F.try_url_decode(text)
