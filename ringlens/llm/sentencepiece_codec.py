"""SentencePiece encoding and decoding of whole texts with a given model's pieces and scores.

The pieces are searched as a unigram model (best sum of scores), whatever method made them. Each Python worker builds the
Aho-Corasick automaton once; chunks of a text that no piece can cross are segmented one by one and kept while they recur,
so memory is bounded by the longest text and two generations of chunks.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import small_batches
from ringlens.llm.unigram import Segmenter, load_pieces, segmenter

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _lists(rows: list[bytes | None]) -> pa.Array:
    """Runs of 32-bit ids as one Arrow array of lists, null for None."""
    offsets, values = [0], array("i")
    for r in rows:
        values.frombytes(r or b"")
        offsets.append(len(values))
    out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(values, np.int32), pa.int32()))
    return pa.ListArray.from_arrays(
        out.offsets, out.values, mask=pa.array([r is None for r in rows], pa.bool_())
    )


def _texts(seg: Segmenter, spelling: pa.Array, ids: pa.ListArray) -> Iterator[str | None]:
    """The text of each list of ids. The spellings of a batch are taken at once and lie joined in one buffer."""
    rows = np.asarray(ids.offsets)
    taken = spelling.take(ids.values.slice(rows[0], rows[-1] - rows[0]).fill_null(seg.table.unknown_id))
    _, offsets, joined = taken.buffers()
    ends = np.frombuffer(offsets, np.int64)[taken.offset :][rows - rows[0]] if len(taken) else rows * 0
    joined = memoryview(joined or b"")
    for null, start, end in zip(ids.is_null().to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
        yield None if null else seg.decode_bytes(bytes(joined[start:end]))


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "token_ids", model: str = MODEL) -> DataFrame:
    """``df`` with ``ids_col``: array<int> of the text's piece ids. Null gives null, the empty text no ids.

    A column of that name is replaced; all others stay. Equal rows give equal ids, each in its own row."""
    table = load_pieces(model)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seg = segmenter(table)
        for column in texts:
            yield _lists([None if t is None else seg.encode_bytes(t) for t in column.to_pylist()])

    ids = F.arrow_udf(run, "array<int>")
    return small_batches(df).withColumn(ids_col, ids(F.col(f"`{text_col}`")))


def decode(df: DataFrame, ids_col: str = "token_ids", text_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with ``text_col``: the text that the ids spell. Null gives null, no ids the empty text."""
    table = load_pieces(model)

    def run(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seg = segmenter(table)
        spelling = pa.array([s or b"" for s in table.spelling], pa.large_binary())
        for ids in column:
            yield pa.array(_texts(seg, spelling, ids), pa.string())

    text = F.arrow_udf(run, "string")
    return small_batches(df).withColumn(text_col, text(F.col(f"`{ids_col}`")))
