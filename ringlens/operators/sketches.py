"""Distinct counts and quantiles per time step that can be merged for any range of steps without reading the rows again.

A step is one row with a distinct-count sketch per end of the edges and a quantile sketch of the weights, some kilobytes whatever the number
of its edges. They combine before the shuffle, so a hot step costs a task one sketch per map task. Stored, a range of steps is
answered by the union of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.functions.columns import finite_double

LG_K = 12  # 2 ** 12 registers of a distinct-count sketch
QUANTILE_K = 400
QUANTILES = (0.25, 0.5, 0.95)


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = QUANTILE_K) -> float:
    """How far the rank of an estimated quantile may be from the rank asked for, as a share of the values, with 99 % confidence.

    The formula is the one that the sketch's public library states.
    """
    return 2.296 / k**0.9021


def step_sketches(edges: DataFrame, step: str, src: str, dst: str, weight: str, lg_k: int = LG_K, k: int = QUANTILE_K) -> DataFrame:
    """``step, n_edges, n_weights, src_sketch, dst_sketch, weight_sketch``: one row per step, also for the null step.

    Null keys are not counted; weights that are null, malformed or not finite are in no quantile and not in ``n_weights``. The keys are counted as text.
    """
    rows = edges.select(
        F.col(f"`{step}`").alias("step"), F.col(f"`{src}`").cast("string").alias("src"), F.col(f"`{dst}`").cast("string").alias("dst"),
        finite_double(F.col(f"`{weight}`")).alias("w"),
    )
    return rows.groupBy("step").agg(
        F.count(F.lit(1)).alias("n_edges"), F.count("w").alias("n_weights"),
        F.hll_sketch_agg("src", F.lit(lg_k)).alias("src_sketch"), F.hll_sketch_agg("dst", F.lit(lg_k)).alias("dst_sketch"),
        F.kll_sketch_agg_double("w", F.lit(k)).alias("weight_sketch"),
    )


def merge_steps(sketches: DataFrame, *by: str) -> DataFrame:
    """The union of the rows with equal ``by`` columns, or of all rows; merging merged rows gives what merging all at once gives."""
    aggs = [
        F.coalesce(F.sum("n_edges"), F.lit(0)).alias("n_edges"), F.coalesce(F.sum("n_weights"), F.lit(0)).alias("n_weights"),
        F.hll_union_agg("src_sketch").alias("src_sketch"), F.hll_union_agg("dst_sketch").alias("dst_sketch"),
        F.kll_merge_agg_double("weight_sketch").alias("weight_sketch"),
    ]
    return sketches.groupBy(*by).agg(*aggs)


def estimates(sketches: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """The other columns of ``sketches`` with ``src_nodes, dst_nodes`` (estimated) and ``weight_quantiles`` (array; null without weights)."""
    kept = [c for c in sketches.columns if not c.endswith("_sketch")]
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return sketches.select(
        *kept, F.hll_sketch_estimate("src_sketch").alias("src_nodes"), F.hll_sketch_estimate("dst_sketch").alias("dst_nodes"),
        F.when(F.col("n_weights") > 0, F.kll_sketch_get_quantile_double("weight_sketch", asked)).alias("weight_quantiles"),
    )
