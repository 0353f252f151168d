"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.llm.chat_format import conversation_digests, format_chat
from ringlens.llm.embedding_dedup import embedding_components
from ringlens.llm.fingerprints import edited_fingerprints
from ringlens.llm.hard_negatives import hard_negatives
from ringlens.llm.jaccard_join import jaccard_components
from ringlens.llm.language_id import language_id
from ringlens.llm.license_scan import license_scan
from ringlens.llm.mixing import mixing_counts
from ringlens.llm.pii import personal_data
from ringlens.llm.sentencepiece_codec import decode, encode
from ringlens.llm.token_counts import token_counts
from ringlens.llm.url_filter import url_filter
from ringlens.llm.vector_codes import code_errors

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether they decode to the text again."""
    coded = decode(encode(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select(
        "doc_id", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"), "token_ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, fitted on the documents that are not held out."""
    return language_id(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix with weights 5, 2, 1 and 150 % of all words takes of every document."""
    return mixing_counts(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of the embeddings of a label with a cosine of 0.93 or more."""
    return embedding_components(_table(spark, sf_dir, "embeddings"), reach=0.93)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return license_scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_licenses", F.array_join(F.transform("licenses", lambda m: m["license"]), ",").alias("licenses"),
        "best_license", "best_dice",
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(_table(spark, sf_dir, "pages"), rules)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of pieces of every whole text."""
    return token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    return personal_data(_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard_components(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 8 parts with 16 entries each for every embedding, after 6 rounds, and their errors."""
    return code_errors(_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three negatives for each of five positives of every embedding whose id is divisible by 50; ids divisible by 7 have a wrong label."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=wrong)


PLANTED_CHAT = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one that holds control strings, read back from their training windows."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED_CHAT, rows.schema)
    return conversation_digests(format_chat(rows.union(planted)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_sentencepiece, op2_language_id, op3_mixing, op4_embedding_dedup, op5_license_scan, op6_url_filter,
              op7_token_counts, op8_pii, op9_fingerprints, op10_jaccard_join, op11_vector_codes, op12_hard_negatives, op13_chat_format)
}
