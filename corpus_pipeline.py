"""The corpus pipeline: five stages from raw documents to encoded training data.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents, with any further columns that the input has. ``ORACLE_SQL`` is None: the
stages end in trained models and a Viterbi search, which SQL does not express; tests hold them against brute force.

Rows that repeat an id: the language and privacy stages judge every row by its own text. The Jaccard stage keeps a row if its id is
its group's smallest, and of equal rows that share an id one. A null id is never a group's smallest unless all ids
of the group are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.llm import language_id, pii
from ringlens.llm.common import broadcast_checked, fresh, only_columns, small_batches
from ringlens.llm.jaccard_join import jaccard_components
from ringlens.llm.mixing import mix
from ringlens.llm.sentencepiece_codec import encode
from ringlens.plans.runtime import materialize

# Executors and Python workers live through all stages and keep what they once took, so batches are smaller than those of a single operator.
BATCH_BYTES = 1 << 20


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected: they have letters and are near a learned language."""
    docs = small_batches(docs, BATCH_BYTES)
    model = language_id.fit(only_columns(docs, doc_id="doc_id", text="text", lang="lang"))
    judged = language_id.identify(docs, model, out_col=(name := fresh(docs, "language")))
    return judged.filter(~F.col(f"{name}.rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    docs = small_batches(docs, BATCH_BYTES)
    found = materialize(jaccard_components(docs, width=5, percent=80).select("doc_id", "component_id"), "groups")
    gone = found.groupBy("doc_id").agg(
        F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), 0).otherwise(1)).alias("out"), F.count(F.lit(1)).alias("rows")
    ).filter("out = 1 or rows > 1")
    gone = materialize(gone.select(F.col("doc_id").alias("gone_id"), "out"), "groups")
    few = broadcast_checked(gone, gone.count())
    mark = fresh(docs, "gone")
    marked = few.select("gone_id", F.col("out").alias(mark))
    joined = docs.join(marked, docs["doc_id"].eqNullSafe(marked["gone_id"]), "left")
    once = joined.filter(F.col(mark).isNull()).select(*docs.columns)
    repeated = joined.filter((F.col(mark) == 0) & docs["doc_id"].isNotNull()).select(*docs.columns).dropDuplicates(["doc_id", "text"])
    nameless = joined.filter((F.col(mark) == 0) & docs["doc_id"].isNull()).select(*docs.columns)
    return once.union(repeated).union(nameless)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    docs = small_batches(docs, BATCH_BYTES)
    trees = pii.fit(docs.select("text"))
    found = pii.find_pii(docs, trees, out_col=(name := fresh(docs, "pii")))
    text = F.col(f"{name}.redacted")
    changed = {"text": text, "n_chars": F.when(F.col(f"{name}.spans") != "", F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return found.withColumns({k: v for k, v in changed.items() if k in docs.columns}).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids instead of the text."""
    coded = encode(small_batches(docs, BATCH_BYTES), ids_col="token_ids")
    return coded.withColumn("n_tokens", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long")).drop("text")


STAGES = [
    ("language_id", languages),
    ("jaccard_join", near_duplicates),
    ("pii", privacy),
    ("mixing", mixture),
    ("sentencepiece", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
