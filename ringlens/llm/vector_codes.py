"""Product-quantised codes of vectors: exact integer k-means per part, with pivots that spare most distances (LAESA).

Each component becomes the integer ``floor(scale * x)``; a vector is cut into equal consecutive parts, and each part position has a
codebook of its own. The distance of every part to a few fixed pivots is computed once and written beside the vectors. In each round the
driver knows the distances between pivots and entries, so ``max |d(part, pivot) - d(pivot, entry)|`` bounds the distance of part and entry
from below: entries are tried in the order of that bound, exact integer distances are evaluated only while the bound does not exceed the
best one, and ties go to the lower index. The result is that of comparing everything.

A round is one pass over the written table. A task adds up its parts per entry and sends sums, not rows; Spark adds the sums
by position, and the driver receives one codebook (``parts * entries`` rows of numbers, whatever the number of vectors). Codebook and
pivots go to the tasks with the function, a size that parameters and dimension fix.

Defined results: vectors that are null or hold a null or non-finite component are dropped. Shorter vectors are filled with zeros to the longest
one's length, and all to a multiple of the number of parts. With fewer vectors than entries the codebook is as small as they are; the
first entries come by ascending id, null ids last, rows that share an id by their vector. Repeated rows count as often as they occur. An empty
table gives an empty result. Numbers of any size stay exact (beyond the range of 64 bits as Python integers, without pivots); an
error that does not fit a long is given as the largest long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import broadcast_checked, only_columns, small_batches
from ringlens.plans.runtime import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
PIVOTS = 4  # fixed pivots per part position
LIMB = 40  # bits of a limb, in which sums of any size travel as longs
MAX_LONG = (1 << 63) - 1
SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])


@dataclass(frozen=True)
class Layout:
    """How vectors become parts: ``width`` components each."""

    parts: int
    width: int
    scale: int


def integers(column: pa.Array, layout: Layout) -> np.ndarray:
    """(vectors, parts, width) of integers; int64 if squared distances fit, else Python integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    full = np.zeros((len(size), layout.parts * layout.width))
    full[np.arange(full.shape[1]) < size[:, None]] = flat
    with np.errstate(over="ignore"):
        scaled = np.floor(full * layout.scale)
    most = float(np.abs(scaled).max(initial=0.0))
    if 4.0 * max(layout.width, 1) * most * most < 2.0**61:
        out = scaled.astype(np.int64)
    else:  # a double this large may overflow when it is scaled, its integer does not
        out = np.empty(full.shape, object)
        out[...] = [[_floor(x, layout.scale) for x in row] for row in full.tolist()]
    return out.reshape(len(size), layout.parts, layout.width)


def _floor(x: float, scale: int) -> int:
    over, under = x.as_integer_ratio()
    return scale * over // under


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis; exact for int64 within ``integers``' bound and for Python integers."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


def fits(*arrays: np.ndarray) -> bool:
    """All of them are 64-bit, so that pivot distances can be used."""
    return all(a.dtype != object for a in arrays)


def choose_pivots(book: np.ndarray, n: int) -> np.ndarray:
    """``n`` entries of a codebook that lie far from each other, greedily, the first entry first."""
    chosen = [0]
    while len(chosen) < min(n, len(book)):
        near = np.array([min(int(squared(book[i], book[j])) for j in chosen) for i in range(len(book))], object)
        chosen.append(int(np.argmax(near)))
    return book[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances in doubles; NaN, which bounds nothing, where the numbers are too large."""
    out = np.full((len(x), len(pivots)), np.nan)
    if fits(x, pivots):
        for j, p in enumerate(pivots):
            out[:, j] = np.sqrt(squared(x, p).astype(np.float64))
    return out


def nearest(x: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry, ties to the lower index, and how many distances it took."""
    n, k = len(x), len(book)
    at = np.full(n, k, np.int64)
    exact = fits(x, book)
    if not exact:
        x, book = x.astype(object), book.astype(object)
    best = np.full(n, np.iinfo(np.int64).max) if exact else np.full(n, None, object)
    bound = np.zeros((n, k))
    if exact:
        for j in range(to_pivots.shape[1]):
            a, b = to_pivots[:, j, None], entry_pivots[None, :, j]
            np.fmax(bound, np.abs(a - b) - 1e-12 * (a + b), out=bound)  # the doubles' rounding never raises a bound
    least = bound * bound * (1 - 1e-12)
    order = np.argsort(bound, axis=1, kind="stable")
    rows, taken = np.arange(n), 0
    for r in range(k):
        entry = order[rows, r]
        if exact:
            alive = least[rows, entry] <= best[rows]
            rows, entry = rows[alive], entry[alive]
        if not len(rows):
            break
        d = squared(x[rows], book[entry])
        taken += len(rows)
        if r == 0:
            better = np.ones(len(rows), bool)
        else:
            better = (d < best[rows]) | ((d == best[rows]) & (entry < at[rows]))
        better = better.astype(bool)
        best[rows[better]], at[rows[better]] = d[better], entry[better]
    return at, best, taken


class Books:
    """The codebooks of all parts, and their entries' distances to the pivots."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray]):
        self.entries, self.pivots = entries, pivots  # (parts, entries, width); per part (pivots, width)
        self.to_pivots = [pivot_distances(entries[p], pivots[p]) for p in range(len(pivots))]

    def assign(self, x: np.ndarray, to_pivots: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, nearest entry, squared distance) of all rows, part by part."""
        at = 0
        for p, pivots in enumerate(self.pivots):
            index, distance, _ = nearest(x[:, p], to_pivots[:, at : at + len(pivots)], self.entries[p], self.to_pivots[p])
            at += len(pivots)
            yield p, index, distance

    def moved(self, sums: dict[tuple[int, int, int], int]) -> Books:
        """Each entry replaced by the componentwise floor of its parts' mean; entries without parts stay."""
        new = self.entries.astype(object)
        for p, e in np.ndindex(new.shape[:2]):
            if count := sums.get((p, e, -1), 0):
                new[p, e] = [sums.get((p, e, i), 0) // count for i in range(new.shape[2])]
        most = max((abs(v) for v in new.ravel().tolist()), default=0)
        if 4 * max(new.shape[2], 1) * most * most < 2**61:
            new = new.astype(np.int64)
        return Books(new, self.pivots)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for v in self.entries.ravel().tolist()).encode()).hexdigest()


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """``value`` as (place, limb); only the last limb can be negative."""
    at = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield at, value & ((1 << LIMB) - 1)
        value >>= LIMB
        at += 1
    yield at, value


def _distances(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return batch.column("to_pivots").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)


def _sums(table: DataFrame, books: Books, layout: Layout) -> dict[tuple[int, int, int], int]:
    """One round over the table: the sum per part, entry and component, and under component -1 the count."""
    width, n_pivots = layout.width, sum(len(p) for p in books.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*books.entries.shape[:2], width + 1), object)
        for batch in batches:
            x = integers(batch.column("vec"), layout)
            for p, index, _ in books.assign(x, _distances(batch, n_pivots)):
                for e in np.unique(index):
                    mine = index == e
                    # a batch's sums fit: its components are below 2**30 unless they are Python integers
                    total[p, e, :width] += x[mine, p].sum(axis=0).astype(object)
                    total[p, e, width] += int(mine.sum())
        rows = [
            (p, e, i if i < width else -1, limb, value)
            for (p, e, i), v in np.ndenumerate(total) if total[p, e, width] for limb, value in _limbs(int(v))
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SUMS, strict=True)], schema=SUMS)

    parts = table.select("vec", "to_pivots").mapInArrow(run, "part int, entry int, place int, limb int, value long")
    added = parts.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value"))
    out: dict[tuple[int, int, int], int] = {}
    for r in added.collect():  # one codebook
        key = (r.part, r.entry, r.place)
        out[key] = out.get(key, 0) + (r.value << (LIMB * r.limb))
    return out


def vector_codes(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
) -> tuple[DataFrame, Books | None]:
    """``id, label, codes array<int>, error`` of every kept vector, and the codebooks (None if no vector is kept)."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    rows = only_columns(small_batches(df), id=id_col, label=label_col, vec=vec_col)
    rows = rows.select("id", "label", F.col("vec").cast("array<double>").alias("vec"))
    kept = rows.filter(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    longest = kept.agg(F.max(F.size("vec"))).first()[0]
    named = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "label"))
    coded = f"{named}, codes array<int>, error long"
    if longest is None:
        return df.sparkSession.createDataFrame([], coded), None
    layout = Layout(parts, -(-longest // parts), scale)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    start = integers(pa.array([r.vec for r in first], pa.list_(pa.float64())), layout).transpose(1, 0, 2)
    books = Books(start, [choose_pivots(start[p], pivots) for p in range(parts)])
    fixed = books.pivots
    n_pivots = sum(len(p) for p in fixed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column("vec"), layout)
            away = np.concatenate([pivot_distances(x[:, p], fixed[p]) for p in range(parts)], axis=1)
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, away.size + 1, n_pivots, dtype=np.int32)), pa.array(away.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=["id", "label", "vec", "to_pivots"])

    table = materialize(kept.mapInArrow(measure, f"{named}, vec array<double>, to_pivots array<double>"), "vector-parts")
    for _ in range(rounds):
        books = books.moved(_sums(table, books, layout))
    last = books

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, parts), np.int32)
            error = np.zeros(batch.num_rows, object)
            for p, index, distance in last.assign(integers(batch.column("vec"), layout), _distances(batch, n_pivots)):
                codes[:, p] = index
                error += distance.astype(object)
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32)), pa.array(codes.ravel()))
            capped = pa.array([min(int(v), MAX_LONG) for v in error], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), column, capped], names=["id", "label", "codes", "error"])

    return table.mapInArrow(encode, coded), books


def code_errors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", **settings: int) -> DataFrame:
    """``id_col, code, error, label_error, codebooks_sha256``: the codes as two hexadecimal digits each, errors per vector and label.

    Errors are added up per label before any join, so a label with most of the rows is no hot key; the table of labels is
    broadcast if it is counted to be small.
    """
    codes, books = vector_codes(df, id_col, vec_col, label_col, **settings)
    codes = materialize(codes, "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long")
    labels = materialize(codes.groupBy(F.col("label").alias("of_label")).agg(total.alias("label_error")), "label-errors")
    few = broadcast_checked(labels, labels.count())
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return codes.join(few, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        F.col("id").alias(id_col), code.alias("code"), "error", "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )
