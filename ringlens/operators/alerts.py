"""The alert table: flagged clusters day by day, and the drift of their metrics.

The table is a Parquet folder partitioned by ``day``. A run writes the partition of its day and no other, in one commit, so running a
day again replaces what it wrote and adds nothing. Every run also writes a row without key, which keeps a day without flags a
written day. When a key was seen first and last is read from the days, so days may be run in any order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringlens.plans.runtime import materialize


def publish_alerts(flagged: DataFrame, key: str, day: str, path: str) -> DataFrame:
    """Writes the flagged clusters of ``day`` (``YYYY-MM-DD``) into the table at ``path``; returns those that no earlier day has.

    ``flagged`` has one row per alert; rows with a null key are left out, of rows with the same key the first by all other columns stays. ``key`` should name the
    same cluster on every day (see ``matching.carry_identity``). The schema must stay the same from run to run.
    """
    day = dt.date.fromisoformat(day).isoformat()
    spark = flagged.sparkSession
    others = [c for c in flagged.columns if c != key]
    one = flagged.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`")).agg(F.min(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in others])).alias("row"))
    today = materialize(one.select(F.col(f"`{key}`"), *[F.col(f"row.`{c}`").alias(c) for c in others]), "alerts-today")
    earlier = _days(spark, path)
    fresh = today if earlier is None else today.join(
        earlier.filter(F.col("day") < F.lit(day).cast("date")).filter(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`")).distinct(), key, "left_anti"
    )
    fresh = materialize(fresh, "alerts-new")  # before the write, which replaces a part of the folder that this reads
    ran = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in today.schema])
    today.union(ran).withColumn("day", F.lit(day).cast("date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return fresh


def _days(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.parquet(path) if exists else None


def read_alerts(spark: SparkSession, key: str, path: str) -> DataFrame:
    """``key, first_seen, last_seen, n_days, open`` and the other columns as of the last day; ``open`` if that is the last day written."""
    days = spark.read.parquet(path)
    others = [c for c in days.columns if c not in (key, "day")]
    newest = days.agg(F.max("day")).scalar()
    seen = days.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`")).agg(
        F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.count(F.lit(1)).alias("n_days"),
        F.max_by(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in others]), "day").alias("row"),
    )
    return seen.select(key, "first_seen", "last_seen", "n_days", (F.col("last_seen") == newest).alias("open"), *[F.col(f"row.`{c}`").alias(c) for c in others])


def sliced_density(edges: DataFrame, assignments: DataFrame, slice_col: str = "slice") -> DataFrame:
    """``slice, cluster, n_nodes, n_edges, internal_density``: pairs of each time slice inside given clusters (``id, cluster``).

    ``edges`` has the slice, src and dst; repeated and reversed pairs count once a slice, loops never. ``n_nodes`` are the cluster's nodes with any edge in the
    slice, also one that leaves the cluster. Clusters without such a node have no row in a slice.
    """
    pairs = edges.filter("src <> dst").select(
        F.col(f"`{slice_col}`").alias("slice"), F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")
    ).distinct()
    pairs = materialize(pairs, "sliced-pairs")
    named = assignments.filter("cluster is not null")
    ends = pairs.select("slice", F.col("src").alias("id")).union(pairs.select("slice", F.col("dst").alias("id"))).distinct()
    nodes = ends.join(named, "id").groupBy("slice", "cluster").agg(F.count(F.lit(1)).alias("n_nodes"))
    inner = (
        pairs.join(named.select(F.col("id").alias("src"), "cluster"), "src")
        .join(named.select(F.col("id").alias("dst"), F.col("cluster").alias("other")), "dst").filter("cluster = other")
        .groupBy("slice", "cluster").agg(F.count(F.lit(1)).alias("n_edges"))
    )
    n = F.col("n_nodes").cast("double")
    possible = n * (n - 1.0) / 2.0
    return nodes.join(inner, ["slice", "cluster"], "left").select(
        "slice", "cluster", "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges"),
        F.when(possible > 0, F.coalesce("n_edges", F.lit(0)) / possible).otherwise(F.lit(0.0)).alias("internal_density"),
    )


def drift(series: DataFrame, value: str, baseline: int, slack: float, limit: float) -> DataFrame:
    """``series`` (``slice, cluster`` and the value) with ``change, expected, cusum_down, cusum_up, alarm``.

    ``change`` is the difference to the slice before (null in the first), ``expected`` the mean of a cluster's first ``baseline`` slices. The cumulative sums take how
    far a value lies below or above what was expected by more than ``slack``, and never fall under 0: the sum of all slices so far less the
    lowest such sum, or 0, so no fold over rows is needed. ``alarm`` if one of them, rounded to 9 places, is over ``limit``. A null value adds nothing. A
    cluster has one row per slice, which bounds a group by the number of slices.
    """
    order = Window.partitionBy("cluster").orderBy("slice")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(f"`{value}`")
    first = series.withColumn("_nth", F.row_number().over(order)).withColumn(
        "expected", F.avg(F.when(F.col("_nth") <= baseline, v)).over(Window.partitionBy("cluster"))
    )

    def running(off):
        return F.sum(F.coalesce(off - F.lit(slack), F.lit(0.0))).over(upto)

    summed = first.withColumns({
        "change": v - F.lag(v).over(order), "_down": running(F.col("expected") - v), "_up": running(v - F.col("expected")),
    })
    # the sum starts at 0, so the lowest one so far is at most 0
    out = summed.withColumns({
        f"cusum{side}": F.col(side) - F.least(F.min(side).over(upto), F.lit(0.0)) for side in ("_down", "_up")
    })
    over = (F.round("cusum_down", 9) > limit) | (F.round("cusum_up", 9) > limit)
    return out.withColumn("alarm", over).drop("_nth", "_down", "_up")
