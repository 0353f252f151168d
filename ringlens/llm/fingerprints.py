"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs, in DataFrame functions only.

A paragraph is the text up to and with a line break, or up to a sentence end and the white space character after it. Each
paragraph hashes to a wide vector; the fingerprint is the sum of the vectors, every lane modulo a power of two. So the order of
paragraphs does not count, equal multisets have equal fingerprints, and a paragraph is inserted or deleted by adding or
subtracting its vector, without the rest of the text.

Written in lower-case hex, a fingerprint has
* the number of paragraphs, modulo 2**32 (8 digits),
* ``WIDE`` lanes modulo 2**32 (8 digits each) into which every paragraph is added: they tell equality,
* per rate in ``RATES`` ``THIN`` lanes modulo 2**8 (2 digits each) into one of which a paragraph is added if it is in the
  rate's share: the lanes that differ estimate how many paragraphs do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringlens.llm.common import only_columns

WIDE = 8
RATES = (0, 4, 8)  # shares of the paragraphs by power of two: all, a 16th, a 256th
THIN = 64
HEAD = 8 + 8 * WIDE
DIGITS = HEAD + 2 * THIN * len(RATES)
BUCKET_ROWS = 2048  # documents per bucket of consecutive ids, as long as there are at most STEPS ** 2 buckets
STEPS = 128

_CUT = r"(?<=\n)|(?<=[.!?][\x20\x09])"


def paragraphs(text: Column) -> Column:
    """The text's paragraphs with their ends, which together are the text; none for null and empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _CUT, -1), lambda p: p != F.lit(""))


def _sum(values: Column, part, modulus: int) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: (a + part(x)) % modulus)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as hex; null counts as the empty text, whose lanes are all 0."""
    names = F.transform(paragraphs(text), lambda p: F.xxhash64(p))
    return F.element_at(F.transform(F.array(names), _lanes), 1)


def _lanes(names: Column) -> Column:
    def hex_of(value: Column, digits: int) -> Column:
        return F.lpad(F.lower(F.hex(value)), digits, "0")

    def low(w: Column) -> Column:
        return w.bitwiseAND(F.lit(0xFFFFFFFF))

    def high(w: Column) -> Column:
        return F.shiftrightunsigned(w, 32)

    def lane_of(chosen: Column):
        def value(lane: Column) -> Column:
            mine = F.filter(chosen, lambda s: s.bitwiseAND(F.lit(THIN - 1)) == lane)
            return hex_of(_sum(mine, lambda s: F.shiftrightunsigned(s, 8).bitwiseAND(F.lit(255)), 256), 2)

        return value

    def hashed(seed: int) -> Column:
        return F.transform(names, lambda h: F.xxhash64(F.lit(seed), h))

    def sampled(seed: int, rate: int) -> Column:
        return F.filter(hashed(seed), lambda s: F.shiftrightunsigned(s, 20).bitwiseAND(F.lit((1 << rate) - 1)) == 0)

    parts = [hex_of(F.size(names).cast("long"), 8)]
    for j in range(WIDE // 2):  # one 64-bit hash of the name makes two lanes
        parts += [hex_of(_sum(hashed(j), half, 1 << 32), 8) for half in (low, high)]
    for k, rate in enumerate(RATES):
        lanes = F.transform(
            F.array(sampled(100 + k, rate)), lambda chosen: F.transform(F.sequence(F.lit(0), F.lit(THIN - 1)), lane_of(chosen))
        )
        parts.append(F.array_join(F.element_at(lanes, 1), ""))
    return F.concat(*parts)


def _lane_values(fp: Column, digits: int, start: int, count: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.conv(F.substring(fp, (i * digits + start + 1).cast("int"), F.lit(digits)), 16, 10).cast("long"),
    )


def _combine(a: Column, b: Column, sign: int) -> Column:
    def lanes(digits: int, start: int, count: int) -> Column:
        modulus = 1 << (4 * digits)
        both = F.zip_with(
            _lane_values(a, digits, start, count), _lane_values(b, digits, start, count),
            lambda x, y: F.lpad(F.lower(F.hex(F.pmod(x + y * F.lit(sign), F.lit(modulus)))), digits, "0"),
        )
        return F.array_join(both, "")

    return F.concat(lanes(8, 0, 1 + WIDE), lanes(2, HEAD, THIN * len(RATES)))


def insert(fp: Column, more: Column) -> Column:
    """The fingerprint of a text after the paragraphs of fingerprint ``more`` are put in, anywhere."""
    return _combine(fp, more, 1)


def delete(fp: Column, less: Column) -> Column:
    """The fingerprint after the paragraphs of ``less``, which the text has, are taken out."""
    return _combine(fp, less, -1)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else an estimate in [0, 1) of the share of paragraphs that both texts have.

    The share of lanes that differ tells how many paragraphs do, by the first rate at which few enough differ; twice the common
    paragraphs over all is the likeness.
    """
    total = F.conv(F.substring(a, 1, 8), 16, 10).cast("double") + F.conv(F.substring(b, 1, 8), 16, 10).cast("double")

    def differing(k: int) -> Column:
        start = HEAD + 2 * THIN * k
        at = F.sequence(F.lit(start + 1), F.lit(start + 2 * THIN - 1), F.lit(2))
        return F.size(F.filter(at, lambda i: F.substring(a, i, F.lit(2)) != F.substring(b, i, F.lit(2)))).cast("double")

    def estimate(k: int) -> Column:
        share = F.least(differing(k), F.lit(THIN - 0.5)) / THIN
        here = -F.log(1.0 - share) * THIN * float(1 << RATES[k])
        return here if k + 1 == len(RATES) else F.when(share <= 0.85, here).otherwise(estimate(k + 1))

    near = 1.0 - estimate(0) / total
    return F.when(a == b, 1.0).when(total <= 0, 0.0).otherwise(F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0 - 2.0**-20)))


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of its texts; a column of that name is replaced."""
    return df.withColumn(out_col, fingerprint(F.col(f"`{text_col}`")))


def _bucket(bounds: list[int]) -> Column:
    """The number of bounds that are at most the id, found among every STEPS-th bound first; null ids come last."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    rows = [bounds[i : i + STEPS] for i in range(0, len(bounds), STEPS)]
    coarse = F.size(F.filter(F.array(*[F.lit(r[0]) for r in rows]), lambda b: b <= F.col("doc_id")))
    fine = F.element_at(F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows]), F.greatest(coarse, F.lit(1)))
    found = F.greatest(coarse - 1, F.lit(0)) * STEPS + F.size(F.filter(fine, lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the columns next_text and the row's and the next row's fingerprint.

    Rows are in ascending order of doc_id, null last, then of the text's hash; after the last comes the first. They are dealt
    into buckets of consecutive ids by quantiles of the ids; the first row of the next bucket comes along as a bucket's last. So
    every text is shuffled once, and no task has to sort all.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    n = docs.count()
    steps = min(STEPS * STEPS, -(-n // BUCKET_ROWS))
    bounds: list[int] = []
    if steps > 1:
        at = [i / steps for i in range(1, steps)]
        found = docs.agg(F.percentile_approx("doc_id", at, 10 * steps)).first()[0]
        bounds = sorted(set(found or ()))
    placed = keyed.withColumn("bucket", _bucket(bounds))
    rows = placed.withColumn("print", fingerprint(F.col("text")))
    first = placed.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "tie")).alias("first")
    )
    # a row per bucket, of which there are at most STEPS ** 2 + 1
    order = Window.orderBy("bucket")
    heads = first.select(
        F.col("first.doc_id").alias("head_id"), F.col("first.tie").alias("head_tie"),
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"),
    )
    guests = (
        keyed.join(F.broadcast(heads), keyed["doc_id"].eqNullSafe(heads["head_id"]) & (keyed["tie"] == heads["head_tie"]))
        .groupBy(F.col("before").alias("bucket")).agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "tie")])
        .withColumn("print", fingerprint(F.col("text")))
    )
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    line = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), "tie")
    return (
        both.withColumn("next_text", F.lead("text").over(line)).withColumn("next_print", F.lead("print").over(line))
        .filter("not guest").select("doc_id", "text", "next_text", "print", "next_print")
    )


def edited_fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of its characters (rounded down) replaced by as many first characters of the next
    document, or all it has. Null counts as empty; of rows with one id the order is that of a hash of their texts. A single
    document is its own next. An empty table gives none.
    """
    docs = only_columns(documents, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring(F.col("next_text"), F.lit(1), quarter)
    )
    rows = rows.withColumn("edited", edited).withColumn("edited_print", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
