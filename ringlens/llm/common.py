"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.plans.runtime import materialize

# A table of at most this many rows of a few longs each (some 10 MB) may be broadcast.
BROADCAST_ROWS = 200_000

# The class of white space that separates words in every operator here: space, and tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


# Bytes of an Arrow batch between Spark and its Python workers, so that a batch of very long texts stays small.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame, most: int = BATCH_BYTES) -> DataFrame:
    """``df``; its session sends Arrow batches of at most ``most`` bytes from now on, unless it was set to less.

    Spark's own limit, 64 MB, is held several times over by an executor and its workers."""
    conf = df.sparkSession.conf
    if int(str(conf.get(_BATCH_CONF)).rstrip("b")) > most:
        conf.set(_BATCH_CONF, str(most))
    return df


def free_shuffles(df: DataFrame) -> DataFrame:
    """``df``; asks the driver's JVM to collect garbage. Spark deletes the files of a shuffle when nothing on the driver refers to it any more, which it
    only learns from a collection; without one they stay on the executors' disks long after the table they served is written."""
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def broadcast_checked(df: DataFrame, rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within the bound, else left to a shuffled join."""
    return F.broadcast(df) if rows <= max_rows else df


def only_columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Just the named input columns under this module's own names, so that other columns cannot clash."""
    return df.select(*[F.col(f"`{column}`").alias(name) for name, column in wanted.items()])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node of each node's connected component, as (node, component); nodes without an edge are absent.

    ``edges`` has long columns u and v. Large-star and small-star steps alternate until the edge set stands still:
    every node then points at the smallest node of its component. Both steps are a map-side combined minimum per node
    and a join with it, so a hub is combined before the shuffle and its rows can be split by AQE. Each round is written to
    the shared folder, which cuts the lineage. Self-loops and repeated edges are allowed.
    """
    now = materialize(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "components",
    )
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(state) == before or state[0] == 0:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
                .join(now.select(F.col("u").alias("node")).distinct(), "node", "left_anti")
            )
        before = tuple(state)
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: the larger neighbours of u move to the smallest node around u
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "components")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
