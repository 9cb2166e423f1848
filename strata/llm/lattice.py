"""Embedding near-duplicates by lattice hashing.

Random projections take a vector to eight dimensions, where it is decoded to
the nearest point of the lattice E8; a vector stands in the cell of that point
and, as a probe, in the nearest neighbouring cells, in several tables.  Vectors
that share a cell are compared by cosine in double precision.  Links join into
components; within a component all pairs are then compared in square tiles, so
the number of links is exact there even for pairs that never shared a cell.

Equal vectors are one vector with a multiplicity throughout.  A cell or
component of any size is cut into tiles of bounded size that different tasks
compare, so none gathers in one task.  Links leave a tile only as component
labels or counts, never as pairs.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing, as do vectors of different lengths; rows with a null id have no
component, count for nobody and are not kept; repeated rows are copies; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.groups import group_starts, whole_groups
from strata.llm.words import bounded_batches, mix
from strata.session import settle

#: Tables, neighbouring cells probed per table, and the width of a cell for unit
#: vectors: pairs at cosine 0.9 share a cell with probability 0.985, at 0.93 0.999.
TABLES, PROBES, WIDTH = 8, 2, 1.5
#: Rows of one side of a tile.
TILE = 1024


def minimal_vectors() -> np.ndarray:
    """The 240 vectors to the nearest neighbours of a point of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(found)


_MINIMAL = minimal_vectors()


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """Nearest whole-numbered points with even sum."""
    point = np.rint(y)
    error = y - point
    odd = np.flatnonzero(point.sum(1) % 2 != 0)
    worst = np.abs(error).argmax(1)[odd]
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
    return point


def nearest_point(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8: the even whole-numbered ones and those moved by one half."""
    whole, half = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(1) <= ((y - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def cells(unit: np.ndarray, table: int, probes: int = PROBES, width: float = WIDTH) -> np.ndarray:
    """Cell keys of each vector in one table: its own, then the probed neighbours'."""
    dims = unit.shape[1]
    plane = np.random.default_rng([dims, table]).normal(size=(dims, 8)) / width
    y = unit @ plane
    own = nearest_point(y)
    near = np.argpartition(-((y - own) @ _MINIMAL.T), probes, axis=1)[:, :probes]
    points = np.concatenate([own[:, None], own[:, None] + _MINIMAL[near]], axis=1)
    key = np.full(points.shape[:2], table * 4096 + dims, np.uint64)
    for i in range(8):
        key = mix(key + (2 * points[:, :, i]).astype(np.int64).view(np.uint64))
    return key


def _rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and unit vectors (double) of the lists of each length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    begin = np.cumsum(lengths) - lengths
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        x = flat[begin[at][:, None] + np.arange(dims)]
        x /= np.abs(x).max(1, keepdims=True)
        yield at, x / np.sqrt((x * x).sum(1, keepdims=True))


def _standing(tables: int, probes: int, with_vectors: bool):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, unit in _rows(batch.column("vector")):
                rows = batch.take(pa.array(at))
                for table in range(tables):
                    key = cells(unit, table, probes)
                    for column in key.T:
                        arrays = [pa.array(column.view(np.int64))]
                        arrays += [rows.column("rep"), rows.column("vector")] if with_vectors else []
                        yield pa.RecordBatch.from_arrays(arrays, names=["cell", "rep", "vector"][: len(arrays)])

    return place


def _tile_links(x: np.ndarray, threshold: float) -> np.ndarray:
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    return linked


def _labels(threshold: float):
    """Per tile of a cell: each linked vector with the smallest one it reaches there."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", "i", "j"):
            starts = np.append(group_starts(table, ("cell", "i", "j")), table.num_rows)
            rep = table.column("rep").to_numpy()
            vectors = table.column("vector").combine_chunks()
            a, b = [], []
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                if last - first < 2:
                    continue
                ids = rep[first:last]
                for at, unit in _rows(vectors.slice(first, last - first)):
                    linked = _tile_links(unit, threshold)
                    some = np.flatnonzero(linked.any(1))
                    if not len(some):
                        continue
                    linked, own = linked[np.ix_(some, some)], ids[at[some]]
                    least = own.copy()
                    while True:
                        lower = np.minimum(least, np.where(linked, least, least.max()).min(1))
                        if (lower == least).all():
                            break
                        least = lower
                    a.append(own[own != least])
                    b.append(least[own != least])
            if a:
                pairs = np.unique(np.column_stack([np.concatenate(a), np.concatenate(b)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return label


def _counts(threshold: float):
    """Per tile of a component: links of each vector, copies included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", "i", "j"):
            starts = np.append(group_starts(table, ("cell", "i", "j")), table.num_rows)
            rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
            i, j, own = (table.column(c).to_numpy() for c in ("i", "j", "block"))
            vectors = table.column("vector").combine_chunks()
            total = np.zeros(table.num_rows, np.int64)
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                for at, unit in _rows(vectors.slice(first, last - first)):
                    linked = _tile_links(unit, threshold)
                    if i[first] != j[first]:
                        side = own[first:last][at]
                        linked &= side[:, None] != side
                    total[first + at] = linked @ copies[first:last][at]
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(total)], names=["rep", "n"])

    return count


def _tiled(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of a cell dealt out to the tiles of all pairs of its blocks.

    ``sizes`` has the cells above one tile; Spark decides by its size how to
    join it.  A row of a cell with ``blocks`` blocks stands in as many tiles.
    """
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("rep"), F.col("blocks"))).otherwise(0).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)).cast("int") - 1))
    return (
        rows.join(sizes, "cell", "left")
        .withColumn("block", block)
        .withColumn("other", other)
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("blocks", "other")
        .repartition("cell", "i", "j")
        .sortWithinPartitions("cell", "i", "j")
    )


def _above_one_tile(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("cell")
        .agg(F.ceil(F.count("*") / F.lit(TILE)).cast("long").alias("blocks"))
        .where(F.col("blocks") > 2)
    )


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` and ``kept`` (the smallest id of its component)."""
    bounded_batches(vectors.sparkSession)
    finite = F.forall(
        F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(F.col("vector"), lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    good = F.coalesce(finite & F.col("id").isNotNull(), F.lit(False))
    keyed = rows.select(
        "id", F.when(good, F.xxhash64("vector")).alias("k"), F.when(good, F.hash("vector", F.lit(1))).alias("k2"), "vector"
    )
    distinct = settle(
        keyed.where("k is not null")
        .groupBy("k", "k2", "vector")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )
    plain = distinct.select("rep", "vector")
    shape = plain.schema["vector"].dataType.simpleString()
    standing = plain.mapInArrow(_standing(tables, probes, True), f"cell long, rep long, vector {shape}")
    crowded = _above_one_tile(plain.mapInArrow(_standing(tables, probes, False), "cell long"))
    links = _tiled(standing, settle(crowded, "crowded")).mapInArrow(_labels(threshold), "a long, b long")
    component = connected_components(links)

    member = distinct.join(component, F.col("rep") == F.col("id")).select(
        F.col("component").alias("cell"), "rep", "copies", "vector"
    )
    member = settle(member, "members")
    counted = (
        _tiled(member, _above_one_tile(member))
        .mapInArrow(_counts(threshold), "rep long, n long")
        .groupBy("rep")
        .agg(F.sum("n").alias("n"))
    )
    known = (
        distinct.select("k", "k2", "rep", "copies")
        .join(counted, "rep", "left")
        .join(component.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "k", "k2",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return (
        keyed.select("id", "k", "k2")
        .join(known, ["k", "k2"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )
