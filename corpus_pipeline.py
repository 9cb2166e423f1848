"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, tokens.

Every stage works on all documents that the one before it kept and its
decisions take effect: rejected, repeated and contaminated documents go,
secrets are replaced by their kind, and the last stage gives token ids.  Stages
are stored one by one, so a lost executor repeats part of one stage only.

Rows with a null text have the quality of an empty text, no duplicates and no
tokens; rows with a null id stay unless their quality is poor; of repeated rows
one stays; columns beyond those of ``documents`` are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.decontaminate import contaminated_pairs
from strata.llm.ngram_join import keep_one
from strata.llm.quality import keep_good
from strata.llm.queries import PIECES
from strata.llm.secret_scan import redact_secrets
from strata.llm.sentencepiece_codec import encode_texts
from strata.session import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs.select(*COLUMNS), labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: four fifths of their five-word shingles in common."""
    return keep_one(docs.select(*COLUMNS), shingle=5, percent=80).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = settle(contaminated_pairs(docs, items).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; lengths are those of the new texts."""
    return (
        redact_secrets(docs)
        .withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))
        .select(*COLUMNS)
    )


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return encode_texts(docs, PIECES).select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids"
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", redact),
    ("tokens", tokens),
]

#: The classifier and the tokenizer have no counterpart in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
