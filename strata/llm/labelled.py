"""What the two classifiers share: held-out rows, the bounded sample, binning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows a classifier is fitted on at most: the first by a hash of the id.
TRAIN_ROWS = 20_000
MAX_BINS = 32


def held_out(id_col: str, folds: int = 3) -> Column:
    """True for rows that training may not see; false for a null id."""
    remainder = F.crc32(F.col(id_col).cast("string")) % folds
    return F.coalesce(remainder == 1, F.lit(False))


def training_sample(
    features: DataFrame, labels: DataFrame, id_col: str, label_col: str, rows: int = TRAIN_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Features and 0/1 labels of at most ``rows`` labelled rows outside the held-out fold.

    Which rows is decided by a hash of the id, so the sample is random with
    respect to content, the same in every run, and collected by a top-k.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("y"))
    chosen = (
        features.where(~held_out(id_col))
        .join(known, id_col)
        .orderBy(F.xxhash64(F.col(id_col)), id_col, "y")
        .limit(rows)
        .select("features", "y")
        .toArrow()
    )
    return matrix(chosen.column("features")), chosen.column("y").to_numpy().astype(float)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of equally long lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Inner limits of up to ``MAX_BINS`` bins per feature, by quantile."""
    grid = np.linspace(0, 1, MAX_BINS + 1)[1:-1]
    edges = []
    for column in x.T:
        different = np.unique(column)
        if len(different) <= MAX_BINS:
            edges.append((different[1:] + different[:-1]) / 2)
        else:
            edges.append(np.unique(np.quantile(column, grid)))
    return edges


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
