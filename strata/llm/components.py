"""Connected components by contraction; nothing but joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import settle


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every id that a link names.

    Each round sends every id to its smallest neighbour, follows those pointers
    to their roots by doubling, and contracts the links onto the roots.  At
    most half the ids are roots, so rounds are few, and links shrink with them.
    Minima are combined before the shuffle and joins can be split, so an id
    with very many links gathers in no task.  Links with a null end are none.
    """
    edges = settle(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links"
    )
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v"))
        roots = _roots(settle(least.select("u", F.least("u", "v").alias("p")), "parents"))
        steps.append(roots)
        edges = settle(
            edges.join(roots, "u")
            .select(F.col("p").alias("x"), F.col("v").alias("u"))
            .join(roots, "u")
            .select(F.col("x").alias("u"), F.col("p").alias("v"))
            .where("u <> v")
            .distinct(),
            "links",
        )
    if not steps:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    found = steps[0]
    for later in steps[1:]:
        onward = later.select(F.col("u").alias("p"), F.col("p").alias("q"))
        found = found.join(onward, "p", "left").select("u", F.coalesce("q", "p").alias("p"))
    return settle(found.select(F.col("u").alias("id"), F.col("p").alias("component")), "components")


def _roots(parents: DataFrame) -> DataFrame:
    """Follow pointers ``u`` to ``p`` until every ``p`` points to itself."""
    while True:
        above = parents.select(F.col("u").alias("p"), F.col("p").alias("q"))
        jumped = settle(parents.join(above, "p").select("u", "p", "q"), "parents")
        moved = jumped.where("p <> q").isEmpty()
        parents = jumped.select("u", F.col("q").alias("p"))
        if moved:
            return parents
