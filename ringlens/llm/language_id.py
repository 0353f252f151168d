"""Language identification by nearest centroid.

A text is the vector of its letter n-grams (one to three letters, with word ends), hashed into ``DIM`` places, weighted by
log(1 + count) times inverse document frequency, and normalised. Each language has several centroids, clustered from a
bounded sample of its labelled texts. A text's language is that of the centroid with the largest cosine, which is the score. A text
that is farther from it than nearly all labelled texts of its length are from theirs is rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import only_columns, small_batches

DIM = 1 << 13
SAMPLE = 1000  # labelled texts per language that the centroids are fitted on, about
CLUSTERS = 4
LANGUAGES = 512  # most languages; more is an error, as all centroids go to every task
CHUNK_CHARS, CHUNK_TEXTS = 1 << 18, 64
SLACK = 0.6  # a text is rejected below this times the lowest hundredth of the labelled texts of its length
BINS = 24  # lengths by power of two
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: 1 for letters; 1 for letters and the marks that belong to them."""
    kind = np.fromiter((ord(unicodedata.category(chr(i))[0]) for i in range(0x110000)), np.uint8, 0x110000)
    return kind == ord("L"), (kind == ord("L")) | (kind == ord("M"))


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunk by chunk: counts of n-grams, a row per text, and whether a text has letters."""
    letter, part = _letters()
    i = 0
    while i < len(texts):
        chunk, held = [], 0
        while i < len(texts) and len(chunk) < CHUNK_TEXTS and (not chunk or held + len(texts[i] or "") <= CHUNK_CHARS):
            chunk.append((texts[i] or "").lower())
            held += len(chunk[-1])
            i += 1
        codes = np.frombuffer(("\n" + "\n".join(chunk) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        of = np.repeat(np.arange(len(chunk)), [len(t) + 1 for t in chunk])
        of = np.concatenate([[0], of])
        has = np.bincount(of[letter[codes]], minlength=len(chunk)) > 0
        sign = np.where(part[codes], codes, 0)
        keep = np.concatenate([[True], (sign[1:] != 0) | (sign[:-1] != 0)])
        sign, of = sign[keep].astype(np.uint32), of[keep]
        a, b, c = sign[:-2], sign[1:-1], sign[2:]
        place = np.uint32(0x9E3779B1) * b
        pair = (place ^ (c * np.uint32(0x85EBCA77) + np.uint32(1))) * np.uint32(0xC2B2AE3D)
        triple = (pair ^ (a * np.uint32(0x27D4EB2F) + np.uint32(2))) * np.uint32(0x165667B1)
        shift = np.uint32(32 - (DIM.bit_length() - 1))
        row = of[1:-1] * DIM
        inner = b != 0
        counts = np.zeros(len(chunk) * DIM)
        for gram in (place * np.uint32(0x2545F491), pair, triple):
            counts += np.bincount(row[inner] + (gram[inner] >> shift), minlength=len(counts))
        yield counts.reshape(len(chunk), DIM).astype(np.float32), has


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def length_bin(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts.sum(1) + 1).astype(np.int64), BINS - 1)


def _mean(v: np.ndarray, of: np.ndarray, wide: int = 1024) -> np.ndarray:
    """The mean of some rows of ``v``, of which only ``wide`` columns are copied at once."""
    rows = np.flatnonzero(of)
    return np.concatenate([v[:, i : i + wide][rows].mean(0) for i in range(0, v.shape[1], wide)])


def _cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; the first centre is the mean direction, each further one the vector farthest from all."""
    centres = [v.mean(0)]
    for _ in range(1, min(k, len(v))):
        near = np.max(v @ np.stack([c / max(np.linalg.norm(c), 1e-12) for c in centres]).T, axis=1)
        centres.append(v[int(np.argmin(near))])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        nearest = np.argmax(v @ c.T, axis=1)
        c = np.stack([_mean(v, nearest == j) if (nearest == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def centroids(texts: list[str], idf: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """The centroids of a language's texts and the least cosine by length; none without a text that has letters.

    The vectors, the largest thing by far, are held once: chunks of texts are weighted one by one and written into one array."""
    v, lengths, n = np.empty((len(texts), DIM), np.float32), [np.empty(0, np.int64)], 0
    for counts, has in features(texts):
        counts = counts[has]
        v[n : n + len(counts)] = vectors(counts, idf)
        lengths.append(length_bin(counts))
        n += len(counts)
    v, lengths, least = v[:n], np.concatenate(lengths), np.zeros(BINS)
    if not n:
        return v, least
    c = _cluster(v, clusters)
    own = (v @ c.T).max(1)
    for k in range(BINS):
        if (lengths == k).sum() >= 20:
            least[k] = SLACK * np.quantile(own[lengths == k], 0.01)
    known_bins = np.flatnonzero(least)
    if len(known_bins):  # longer texts are at least as close as the longest labelled ones
        least[known_bins[-1] :] = least[known_bins[-1]]
    return c, least


class Model:
    """Centroids, their languages, the idf weights and the least cosine by language and length."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, of: list[int], languages: list[str], least: np.ndarray):
        self.idf, self.centroids, self.of, self.languages, self.least = idf, centroids, np.array(of), languages, least

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text; texts without letters are ``und``, 0 and rejected."""
        for counts, has in features(texts):
            if not self.languages:
                yield from [(UNKNOWN, 0.0, True)] * len(has)
                continue
            cosine = vectors(counts, self.idf) @ self.centroids.T
            best = np.argmax(cosine, axis=1)
            lang = self.of[best]
            score = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0.0, 1.0)
            far = score < self.least[lang, length_bin(counts)]
            for h, x, s, r in zip(has, lang, score, far, strict=True):
                yield (self.languages[x], float(s), bool(r)) if h else (UNKNOWN, 0.0, True)


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out: crc32 of its id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Fits on (doc_id, text, lang): rows with a language whose id is not null and not held out, about ``sample`` a language."""
    known = small_batches(docs).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counted = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    if len(counted) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = sorted(r["lang"] for r in counted)
    if not languages:
        return Model(np.ones(DIM, np.float32), np.zeros((1, DIM), np.float32), [0], [], np.zeros((1, BINS)))
    rate = F.create_map(*[F.lit(x) for r in counted for x in (r["lang"], min(1.0, sample / r["n"]))])
    chance = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.filter(chance < rate[F.col("lang")]).select("lang", "text")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM, np.int64), 0
        for b in batches:
            for counts, has in features(b.column(1).to_pylist()):
                total += (counts > 0).sum(0)
                n += int(has.sum())
        yield pa.record_batch([pa.array(np.arange(DIM + 1)), pa.array(np.append(total, n))], ["place", "n"])

    seen = picked.mapInArrow(presence, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    by_place = np.zeros(DIM + 1)
    by_place[[r["place"] for r in seen]] = [r["n"] for r in seen]
    idf = np.log((1.0 + by_place[DIM]) / (1.0 + by_place[:DIM])).astype(np.float32) + np.float32(1.0)

    def centres(key: tuple, rows: pa.Table) -> pa.Table:
        c, least = centroids(sorted(set(rows.column("text").drop_null().to_pylist())), idf, clusters)
        lang = pa.array([key[0].as_py()] * len(c), pa.string())
        columns = [lang, pa.array([x.tobytes() for x in c], pa.binary()), pa.array([least.tobytes()] * len(c), pa.binary())]
        return pa.table(columns, ["lang", "centroid", "least"])

    rows = picked.groupBy("lang").applyInArrow(centres, "lang string, centroid binary, least binary").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["centroid"])))
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return Model(idf, np.zeros((1, DIM), np.float32), [0], [], np.zeros((1, BINS)))
    least = {r["lang"]: np.frombuffer(r["least"]) for r in rows}
    return Model(
        idf, np.stack([np.frombuffer(r["centroid"], np.float32) for r in rows]), [languages.index(r["lang"]) for r in rows],
        languages, np.stack([least[x] for x in languages]),
    )


def identify(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``df`` with ``out_col``: struct of lang_pred, score and rejected, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, and rejected. Other columns stay as they are.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = list(model.predict(column.to_pylist()))
            lang, score, far = zip(*found, strict=True) if found else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())],
                ["lang_pred", "score", "rejected"],
            )

    judge = F.arrow_udf(run, "lang_pred string, score double, rejected boolean")
    return small_batches(df).withColumn(out_col, judge(F.col(f"`{text_col}`")))


def language_id(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, clusters: int = CLUSTERS,
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected; fitted on the rows that are not held out.

    Rows without language are predicted like all others. Without any labelled text everything is ``und``.
    """
    docs = only_columns(documents, doc_id=id_col, text=text_col, lang=lang_col)
    model = fit(docs, sample, clusters)
    out = identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "language.*")
