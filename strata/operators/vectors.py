"""Vector search and hashed text vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    BucketedRandomProjectionLSH,
    HashingTF,
    Normalizer,
    RegexTokenizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP_K = 5


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_topk(
    vectors: DataFrame,
    query: Sequence[float],
    k: int = TOP_K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    metric: str = "dot",
    digits: int = 6,
) -> DataFrame:
    """The ``k`` most similar rows with their ``score``, exactly.

    The query travels as a literal, every task keeps its own best ``k`` and
    only those are merged.  Rows are ranked by the exact score (ties by id);
    only the score shown is rounded to ``digits`` places.
    """
    score = {"dot": dot, "cosine": cosine}[metric](F.col(vector_col), F.lit([float(x) for x in query]))
    best = vectors.withColumn("score", score).orderBy(F.col("score").desc_nulls_last(), F.col(id_col)).limit(k)
    return best.withColumn("score", F.round("score", digits))


def centroid(vectors: DataFrame, vector_col: str = "embedding", digits: int = 6) -> list[float]:
    """Mean vector, one number per dimension."""
    parts = vectors.select(F.posexplode(vector_col).alias("pos", "x"))
    means = parts.groupBy("pos").agg(F.round(F.avg(F.col("x").cast("double")), digits).alias("mean"))
    return [row["mean"] for row in means.orderBy("pos").collect()]


def approximate_topk(
    vectors: DataFrame,
    query: Sequence[float],
    k: int = TOP_K,
    vector_col: str = "embedding",
    bucket_length: float = 2.0,
    tables: int = 4,
) -> DataFrame:
    """Nearest rows by Euclidean distance over random-projection buckets."""
    featured = vectors.withColumn("_features", array_to_vector(F.col(vector_col).cast("array<double>")))
    model = BucketedRandomProjectionLSH(
        inputCol="_features", outputCol="_buckets", bucketLength=bucket_length, numHashTables=tables, seed=42
    ).fit(featured)
    nearest = model.approxNearestNeighbors(featured, Vectors.dense([float(x) for x in query]), k, distCol="distance")
    return nearest.drop("_features", "_buckets")


def text_vectorizer(documents: DataFrame, text_col: str = "document", features: int = 4096) -> PipelineModel:
    """Fit hashed TF-IDF vectors of unit length; the model's size is fixed."""
    stages = [
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(documents)


def text_vectors(documents: DataFrame, model: PipelineModel, vector_col: str = "embedding") -> DataFrame:
    return (
        model.transform(documents)
        .withColumn(vector_col, vector_to_array("_unit", "float32"))
        .drop("_words", "_counts", "_weighted", "_unit")
    )
