"""Planted rings and a random background graph, generated on the executors.

Random numbers come from a hash of (seed, ring, pair) rather than a row-order-dependent generator, so a
re-run task (lost executor) or another partitioning yields the same edges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringlens.config import GeneratorConfig, RingSpec

# Fixed value: label of ring r is this prefix followed by the letter A, B, C, ...
RING_LABEL_PREFIX = "fraud_ring_"
_TWO_53 = float(2**53)


def _uniform(*parts: Column) -> Column:
    """Uniform in (0, 1) from a 64-bit hash of the parts."""
    h = F.xxhash64(*parts)
    return (F.pmod(h, F.lit(2**53)).cast(T.DoubleType()) + F.lit(0.5)) / F.lit(_TWO_53)


def hashed_normal(seed: int, *parts: Column) -> Column:
    """Standard normal by Box-Muller from two hashed uniforms."""
    u1 = _uniform(F.lit(seed), F.lit(1), *parts)
    u2 = _uniform(F.lit(seed), F.lit(2), *parts)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def ring_table(spark: SparkSession, rings: tuple[RingSpec, ...] | list[RingSpec]) -> DataFrame:
    """One row per ring spec (a parameter table, as small as the config)."""
    rows = [(i, r.n_nodes, float(r.weight_mean), float(r.weight_std), int(r.id_offset)) for i, r in enumerate(rings)]
    return spark.createDataFrame(rows, "ring int, n_nodes int, weight_mean double, weight_std double, id_offset long")


def ring_pairs(rings: DataFrame) -> DataFrame:
    """``ring, src, dst``: every pair a < b of each ring's members ``id_offset .. id_offset + n - 1``.

    Generated by two nested ``sequence`` explodes per ring (no self join); the output is the clique itself."""
    a = rings.select("*", F.explode(F.sequence(F.lit(0), F.col("n_nodes") - F.lit(2))).alias("a")).filter(
        F.col("n_nodes") >= 2
    )
    ab = a.select("*", F.explode(F.sequence(F.col("a") + F.lit(1), F.col("n_nodes") - F.lit(1))).alias("b"))
    return ab.select(
        "ring",
        "weight_mean",
        "weight_std",
        (F.col("id_offset") + F.col("a")).alias("src"),
        (F.col("id_offset") + F.col("b")).alias("dst"),
    )


def ring_label(ring: Column) -> Column:
    return F.concat(F.lit(RING_LABEL_PREFIX), F.char(F.lit(65) + ring))


def plant_rings(spark: SparkSession, rings, seed: int = 42) -> DataFrame:
    """``src, dst long, weight double, true_label string`` for all ring pairs; weights normal(mean, std),
    rounded to 2 and floored at 1.0."""
    pairs = ring_pairs(ring_table(spark, rings))
    z = hashed_normal(seed, F.col("ring"), F.col("src"), F.col("dst"))
    w = F.greatest(F.round(F.col("weight_mean") + F.col("weight_std") * z, 2), F.lit(1.0))
    return pairs.select("src", "dst", w.alias("weight"), ring_label(F.col("ring")).alias("true_label"))


def background_edges(spark: SparkSession, cfg: GeneratorConfig | None = None) -> DataFrame:
    """``n_normal_edges`` draws of two nodes in 1..n (self pairs skipped), lognormal weights rounded to 2 and
    floored at 1.0, label ``normal``. ``spark.range`` spreads the draws over all tasks."""
    cfg = cfg or GeneratorConfig()
    draws = spark.range(cfg.n_normal_edges)
    n = F.lit(cfg.n_normal_nodes)
    src = (F.floor(_uniform(F.lit(cfg.seed), F.lit(10), F.col("id")) * n) + F.lit(1)).cast(T.LongType())
    dst = (F.floor(_uniform(F.lit(cfg.seed), F.lit(11), F.col("id")) * n) + F.lit(1)).cast(T.LongType())
    z = hashed_normal(cfg.seed, F.lit(12), F.col("id"))
    w = F.greatest(
        F.round(F.exp(F.lit(cfg.background_log_mean) + F.lit(cfg.background_log_sigma) * z), 2), F.lit(1.0)
    )
    return (
        draws.select(src.alias("src"), dst.alias("dst"), w.alias("weight"), F.lit("normal").alias("true_label"))
        .filter(F.col("src") != F.col("dst"))
    )


def synthetic_graph(spark: SparkSession, cfg: GeneratorConfig | None = None) -> DataFrame:
    """Background edges plus the planted rings (the default workload when no input is given)."""
    cfg = cfg or GeneratorConfig()
    return background_edges(spark, cfg).unionByName(plant_rings(spark, cfg.rings, cfg.seed))


def rings_above(spark: SparkSession, background: DataFrame, rings, seed: int = 42) -> DataFrame:
    """Plant rings into an existing graph: ring ids start after the graph's largest node id (the offsets of the
    specs are relative). The offset is a scalar subquery over the graph."""
    top = background.agg(F.greatest(F.max("src"), F.max("dst"))).scalar()
    planted = plant_rings(spark, rings, seed)
    return planted.select(
        (F.col("src") + top + F.lit(1)).alias("src"),
        (F.col("dst") + top + F.lit(1)).alias("dst"),
        "weight",
        "true_label",
    )
