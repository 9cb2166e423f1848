"""Registered queries of the corpus operators, each beside its oracle if SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.decontaminate import contaminated_pairs
from strata.llm.html_text import extract_text
from strata.llm.katz import katz_scores
from strata.llm.lattice import near_duplicates
from strata.llm.ngram_join import ngram_components
from strata.llm.oracles import ORACLES
from strata.llm.pii import find_personal_data
from strata.llm.prefix_trie import conversations_of, prefix_trie, with_shared_heads
from strata.llm.quality import score_quality
from strata.llm.ranked_search import ranked_search
from strata.llm.secret_scan import scan_secrets
from strata.llm.sentencepiece_codec import decode_ids, encode_texts
from strata.llm.toxicity import score_toxicity
from strata.llm.warc import normalise, read_records, with_first_copies, write_archives
from strata.session import scratch_dir

#: A public model of 32,000 pieces; any model of its kind will do.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: The date in the records of the given pages, which have none.
CRAWLED = "2024-01-01T00:00:00Z"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)
    return decode_ids(encoded, PIECES).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.col("decoded").eqNullSafe(F.replace("text", F.lit("\u2581"), F.lit(" "))).alias("round_trip"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return extract_text(pages).select("page_id", F.length("text").cast("long").alias("n_chars"), "text")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda x: x["kind"] != "context")
    return find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(_count(spans, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone", "context")),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda x: x["kind"] != "entropy")
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(_count(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex", "entropy")),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10, share=90)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    pages = with_first_copies(table(spark, sf_dir, "pages"))
    archives = write_archives(pages, f"{folder}/whole", CRAWLED)
    payload = F.col("payload")
    return read_records(normalise(archives, f"{folder}/members")).select(
        "page_id",
        F.coalesce(F.octet_length(payload).cast("long"), "declared_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2(payload, 256), "declared_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(conversations_of(table(spark, sf_dir, "conversations"))))


# What SQL can say of operators that it cannot express as a whole.


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract columns of ``op6_secret_scan`` that the base patterns decide."""
    return op6_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def base_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract columns of ``op5_pii`` that the base patterns decide."""
    return op5_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def base_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract columns of ``op10_katz`` but the model's own score."""
    base = F.round("base_score", 6).alias("base_score")
    return op10_katz(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", base)


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality": op2_quality,
    "op3_ngram_join": op3_ngram_join,
    "op4_html": op4_html,
    "op5_pii": op5_pii,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_lattice": op9_lattice,
    "op10_katz": op10_katz,
    "op11_ranked_search": op11_ranked_search,
    "op12_warc": op12_warc,
    "op13_prefix_trie": op13_prefix_trie,
    "base_secrets": base_secrets,
    "base_personal_data": base_personal_data,
    "base_model": base_model,
}

__all__ = ["ORACLES", "QUERIES"]
