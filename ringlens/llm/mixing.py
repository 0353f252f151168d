"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, and a source's repetition rate is its target over its size. Each
document is emitted floor(rate) times, and once more if a hash of its row, read as a number in [0, 1), is below the
fraction. The draw depends on the row alone: reruns, other partitionings and re-run tasks agree, and equal rows draw
alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import WORD_PATTERN, broadcast_checked, fresh, only_columns
from ringlens.operators.ranking import global_positions
from ringlens.plans.runtime import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2.0  # times its source's size that a target is at most
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(doc_id: Column, source: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the row's id, source and text."""
    parts = [F.coalesce(c.cast("string"), F.lit("-")) for c in (doc_id, source, text)]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources by code point, null last, take the weights in turn. Targets share ``share`` of all words by weight; one that
    would pass ``most`` times its source's size stops there and the excess is shared anew, until none is above. Every
    round is one aggregate over the sources; only its sums reach the driver.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("absent", F.col("source").isNull())
    ranked = global_positions(totals, ["absent", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    sources = materialize(
        ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("limit")),
        "mix-sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    held, free, stopped = 0.0, None, -1
    while True:
        level = F.lit(False) if free is None else F.col("limit") * free <= F.col("weight") * (share * total - held)
        row = sources.agg(
            F.count_if(level), F.sum(F.when(level, F.col("limit")).otherwise(0.0)), F.sum(F.when(level, 0.0).otherwise(F.col("weight")))
        ).first()
        if row[0] == stopped or not row[2]:
            break
        stopped, held, free = row
    rest = F.col("weight") * (share * total - held) / F.lit(free or 1.0)
    return sources.select("source", "source_size", F.least("limit", rest).alias("target"))


def _joined(df: DataFrame, targets: DataFrame, source: str) -> DataFrame:
    t = broadcast_checked(targets, targets.count())
    return df.join(t, df[source].eqNullSafe(t["source_of"]), "left")


def _copies(target: Column, source_size: Column, drawn: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(0.0)
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mixing_counts(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
    share: float = SHARE, most: float = MOST, seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (copies times size).

    Null texts have size 0; null is a source of its own; a source without words has target 0 and no copies. Equal rows
    have equal copies. An empty table gives none.
    """
    docs = only_columns(documents, doc_id=id_col, text=text_col, source=source_col)
    sizes = materialize(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                    draw(F.col("doc_id"), F.col("source"), F.col("text"), seed).alias("drawn")),
        "mix-sizes",
    )
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "source_of")
    found = _joined(sizes, targets, "source").withColumn("copies", _copies(F.col("target"), F.col("source_size"), F.col("drawn")))
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
    share: float = SHARE, most: float = MOST, seed: str = SEED,
) -> DataFrame:
    """The mixed table: the rows of ``documents`` with all their columns, each as often as ``mixing_counts`` says."""
    docs = only_columns(documents, text=text_col, source=source_col)
    sizes = materialize(docs.select("source", n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, share, most).select(
        F.col("source").alias("source_of"), F.struct("target", "source_size").alias(goal := fresh(documents, "goal"))
    )
    drawn = draw(documents[id_col], documents[source_col], documents[text_col], seed)
    copy = fresh(documents, "copy")
    with_goal = _joined(documents, targets, source_col).withColumn(
        copy, _copies(F.col(f"{goal}.target"), F.col(f"{goal}.source_size"), drawn)
    )
    return with_goal.filter(F.col(copy) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(
        *[F.col(f"`{c}`") for c in documents.columns]
    )
