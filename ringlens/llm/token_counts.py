"""Token counts of whole texts: the Viterbi search that carries the best score and its number of pieces, nothing else."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import small_batches
from ringlens.llm.sentencepiece_codec import MODEL
from ringlens.llm.unigram import load_pieces, segmenter


def token_counts(df: DataFrame, text_col: str = "text", count_col: str = "n_tokens", model: str = MODEL) -> DataFrame:
    """``df`` with ``count_col``: long, the number of pieces of the text's best segmentation; null and empty have 0.

    A column of that name is replaced; all others stay."""
    table = load_pieces(model)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seg = segmenter(table)
        for column in texts:
            yield pa.array([seg.count(t) if t else 0 for t in column.to_pylist()], pa.int64())

    count = F.arrow_udf(run, "long")
    return small_batches(df).withColumn(count_col, count(F.col(f"`{text_col}`")))
