"""Global positions in a sort order without a single-partition window.

A global ``row_number() over (order by k)`` moves every row into one task. Here the rows are
range-partitioned on the order key plus a row hash (Spark samples the bounds; the hash spreads a value shared
by a third of the rows over many partitions instead of one), sorted inside each partition, and tagged with
their partition and in-partition position. The hash is a deterministic function of the row, so a re-run map
task after a lost executor sends every row to the same partition as before. The number of partitions is the session's,
coalesced by AQE to its advisory size. The tagged table is written once
to the shared folder, so every later reader sees one partition layout. Per-partition counts (one row per
partition, a proven bound) give each partition its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringlens.plans.runtime import materialize


def global_positions(df: DataFrame, order_cols: list[str], pos_col: str = "pos") -> DataFrame:
    """Add ``pos_col``: the 0-based position of each row in ``ORDER BY order_cols`` (ties in any order)."""
    cols = list(df.columns)
    keys = [*order_cols, "_tie"]
    tagged = (
        df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in cols]))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .drop("_tie")
    )
    tagged = materialize(tagged, "positions")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *cols, (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("long").alias(pos_col)
    )


def dense_ids(keys: DataFrame, key_col: str = "node_key", id_col: str = "node_id") -> DataFrame:
    """Distinct keys -> dense ids 0..n-1 in key order (deterministic, same on any partitioning).

    The tagged positions are written once; every reader of the index adds the broadcast offsets to them."""
    return global_positions(keys.select(key_col).distinct(), [key_col], id_col)


def exact_quantile_value(df: DataFrame, value_col: str, q: float) -> DataFrame:
    """One-row table with the discrete ``q``-quantile of ``value_col``: the value at rank ceil(q*n) (1-based).

    Same definition as SQL ``percentile_disc``; computed by distributed sort instead of gathering all values
    into one aggregation buffer. Empty input -> empty output.
    """
    # the other columns stay in the row hash, so equal values of different rows spread over partitions
    vals = df.select(F.col(value_col).alias("_v"), F.xxhash64(*[F.col(c) for c in df.columns]).alias("_row")).filter(
        F.col("_v").isNotNull()
    )
    ranked = global_positions(vals, ["_v"], "_pos")
    n = vals.agg(F.count(F.lit(1)).alias("_n")).scalar()
    target = F.greatest(F.ceil(F.lit(float(q)) * n) - F.lit(1), F.lit(0))
    return ranked.filter(F.col("_pos") == target).select(F.col("_v").alias("quantile"))
