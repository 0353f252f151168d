"""URL rules decided by a Bloom filter cascade.

A rule names a host and a path; its key is the two written together. A url has a key for each suffix of its host (at dots) and
each path length that a rule uses. The keys of all urls are the universe. The first filter of a cascade holds the listed
keys, the second the unlisted keys of the universe that pass the first by accident, the third the listed keys that pass the
second, and so on until none pass by accident. For every key of the universe the cascade then tells membership exactly,
without a join: the first filter that a key fails, or the last one, says whether it is listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlens.llm.common import only_columns, small_batches
from ringlens.plans.runtime import materialize

FIRST_RATE, FIRST_HASHES = 0.01, 7
MAX_BITS = 1 << 27  # of one filter: 16 MB, some 14 million listed keys; a longer list is an error
MAX_LEVELS = 40


def _positions(h: np.ndarray, g: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit positions of keys with the two 64-bit hashes h and g in the filter of a level: a row per hash function."""
    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    h, g = h.view(np.uint64), g.view(np.uint64)
    seeds = (np.arange(1, hashes + 1, dtype=np.uint64) + np.uint64(1000 * level))[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return (mix(h ^ mix(g + seeds)) % np.uint64(bits)).astype(np.int64)


class Cascade:
    """Levels of (bits, hashes, words); ``listed`` tells which keys of the universe are in the list."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]]):
        self.levels = levels

    def passes(self, h: np.ndarray, g: np.ndarray, level: int) -> np.ndarray:
        bits, hashes, words = self.levels[level]
        p = _positions(h, g, level, bits, hashes)
        return ((words[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).all(axis=0)

    def listed(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        live = np.arange(len(h))
        for level in range(len(self.levels)):
            good = self.passes(h[live], g[live], level)
            out[live[~good]] = level % 2 == 1
            live = live[good]
        out[live] = len(self.levels) % 2 == 1
        return out


def hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h"), F.xxhash64(F.lit("second"), "key").alias("g"))


def _filter(keys: DataFrame, n: int, level: int) -> tuple[int, int, np.ndarray]:
    """The Bloom filter of ``n`` hashed keys: set bits are combined by word on the map side, then gathered."""
    hashes = FIRST_HASHES if level == 0 else 1
    rate = FIRST_RATE if level == 0 else 0.5
    bits = max(64, int(np.ceil(-n * np.log(rate) / np.log(2) ** 2)))
    if bits > MAX_BITS:
        raise ValueError(f"{n} keys need a filter of {bits} bits; at most {MAX_BITS} are sent to every task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, g = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            p = np.unique(_positions(h, g, level, bits, hashes))
            mask = (np.uint64(1) << (p & 63).astype(np.uint64)).view(np.int64)
            yield pa.record_batch([pa.array(p >> 6), pa.array(mask)], ["word", "mask"])

    rows = keys.select("h", "g").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.expr("bit_or(mask)").alias("mask"))
    words = np.zeros((bits + 63) // 64, np.uint64)
    found = rows.toPandas()
    words[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return bits, hashes, words


def _passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    def run(h: pa.Array, g: pa.Array) -> pa.Array:
        h, g = (x.to_numpy(zero_copy_only=False) for x in (h, g))
        return pa.array(cascade.passes(h, g, level))

    return keys.filter(F.arrow_udf(run, "boolean")("h", "g"))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the listed (key) over the universe's (key), which may repeat keys.

    Only the universe's keys that pass the first filter are made distinct and held against the list.
    """
    inside = materialize(hashed(listed.filter("key is not null").distinct()), "url-listed")
    n = inside.count()
    if not n:
        return Cascade([])
    cascade = Cascade([_filter(inside, n, 0)])
    outside = _passing(hashed(universe.filter("key is not null")), cascade, 0).distinct()
    outside = materialize(outside.join(inside.select("key"), "key", "left_anti"), "url-passing")
    for level in range(1, MAX_LEVELS):
        n = outside.count()
        if not n:
            return cascade
        cascade.levels.append(_filter(outside, n, level))
        inside, outside = outside, materialize(_passing(inside, cascade, level), "url-passing")
    raise RuntimeError(f"more than {MAX_LEVELS} levels: two keys have equal hashes")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased) and the path after it up to
    ``?``, ``#`` or end; both empty for null and for urls without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """The keys that can fit a url, longest first, of equal length the longer host first.

    ``labels``: the most labels of a rule's host; ``lengths``: the rules' path lengths."""
    parts = F.split(host, r"\.")
    last = F.least(F.size(parts), F.lit(labels))
    hosts = F.transform(F.sequence(F.lit(1), last), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    fits = F.array(*[F.lit(x) for x in lengths])

    def keys(h: Column) -> Column:
        return F.transform(
            F.filter(fits, lambda n: n <= F.length(path)),
            lambda n: F.struct((F.length(h) + n).alias("size"), F.length(h).alias("host"),
                               F.concat(h, F.substring(path, F.lit(1), n)).alias("key")),
        )

    found = F.flatten(F.transform(hosts, keys))
    return F.transform(F.sort_array(found, asc=False), lambda k: k["key"])


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict (allow or block; rules with a null are left out). The longest rule that fits wins; of
    two verdicts on one key block wins. A url that no listed key fits is not blocked: rule null, verdict allow; so are null
    urls and urls without ``://``, whose host and path are empty. Without rules all urls are allowed.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"]).withColumn("key", F.concat("host", "path"))
    shape = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")
    ).first()
    host, path = host_and_path(F.col("url"))
    urls = only_columns(small_batches(pages), page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    if not shape["labels"]:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    urls = urls.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shape["labels"], sorted(shape["lengths"])))
    universe = urls.select(F.explode("keys").alias("key"))
    cascades = {v: build_cascade(rules.filter(F.col("verdict") == v).select("key"), universe) for v in ("block", "allow")}

    def run(h: pa.Array, g: pa.Array) -> pa.Array:
        # by url: the place of the first listed key, from 1, negative if it is on the allow list; 0 if none is listed
        size = np.diff(h.offsets.to_numpy())
        flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (h, g)]
        block, allow = (cascades[v].listed(*flat) if cascades[v].levels else np.zeros(len(flat[0]), bool) for v in ("block", "allow"))
        out = np.zeros(len(size), np.int64)
        row = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + 1
        hit = np.flatnonzero(block | allow)[::-1]  # the first one is written last
        out[row[hit]] = np.where(block[hit], place[hit], -place[hit])
        return pa.array(out)

    first = F.arrow_udf(run, "long")(
        F.transform("keys", lambda k: F.xxhash64(k)), F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k))
    )
    judged = urls.withColumn("first", first)
    return judged.select(
        "page_id", "host", "path", F.when(F.col("first") != 0, F.element_at("keys", F.abs("first").cast("int"))).alias("rule"),
        F.when(F.col("first") > 0, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
    )
