"""Sketches per step: merged in any way they keep their errors, and wrong ones are noticed."""

import random

import pytest
from pyspark.sql import functions as F

from ringlens.operators import sketches as K


@pytest.fixture(scope="module")
def edges(spark):
    # one step has a third of all rows, one key a third of them
    return spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 40).cast("int")).alias("step"),
        F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.col("id") % 17_000).alias("src"), (F.col("id") % 500).alias("dst"),
        F.when(F.col("id") % 1000 == 0, F.lit(float("nan"))).otherwise(F.pmod(F.hash("id"), F.lit(10_000)).cast("double")).alias("w"),
    )


def _rank_off(values, got, q):
    below, upto = sum(v < got for v in values) / len(values), sum(v <= got for v in values) / len(values)
    return max(below - q, q - upto, 0.0)


def test_steps_and_their_unions_keep_their_errors(spark, edges):
    stored = K.step_sketches(edges, "step", "src", "dst", "w").persist()
    rows = [r for r in edges.collect()]
    merged_twice = K.merge_steps(K.merge_steps(stored.withColumn("part", F.col("step") % 4), "part"))
    assert stored.count() == len({r.step for r in rows})
    for found, chosen in (
        (K.estimates(K.merge_steps(stored)), rows), (K.estimates(merged_twice), rows),
        (K.estimates(K.merge_steps(stored.filter("step between 3 and 20"))), [r for r in rows if 3 <= r.step <= 20]),
        (K.estimates(stored.filter("step = 1").drop("step")), [r for r in rows if r.step == 1]),
    ):
        e = found.first()
        weights = [r.w for r in chosen if r.w == r.w]
        assert (e.n_edges, e.n_weights) == (len(chosen), len(weights))
        for got, true in ((e.src_nodes, len({r.src for r in chosen})), (e.dst_nodes, len({r.dst for r in chosen}))):
            assert abs(got - true) <= 4 * K.distinct_error() * true
        for q, got in zip(K.QUANTILES, e.weight_quantiles):
            assert _rank_off(weights, got, q) <= 2 * K.rank_error()


def test_distinct_unions_do_not_depend_on_the_way(spark, edges):
    stored = K.step_sketches(edges, "step", "src", "dst", "w")
    at_once = K.estimates(K.merge_steps(stored)).first()
    direct = K.estimates(K.step_sketches(edges.withColumn("step", F.lit(0)), "step", "src", "dst", "w")).first()
    true = edges.select("src").distinct().count()
    assert abs(at_once.src_nodes - direct.src_nodes) <= 4 * K.distinct_error() * true and at_once.n_edges == direct.n_edges


def test_nulls_empty_tables_and_names(spark):
    df = spark.createDataFrame([(None, "a", None, None), (1, None, "b", "x"), (1, "a", "b", "2.5")], "n_edges int, src string, dst string, w string")
    got = {r.step: (r.n_edges, r.n_weights, r.src_nodes, r.dst_nodes, r.weight_quantiles) for r in
           K.estimates(K.step_sketches(df, "n_edges", "src", "dst", "w")).collect()}
    assert got == {None: (1, 0, 1, 0, None), 1: (2, 1, 1, 1, [2.5, 2.5, 2.5])}
    none = K.step_sketches(df.limit(0), "n_edges", "src", "dst", "w")
    assert none.count() == 0
    e = K.estimates(K.merge_steps(none)).first()
    assert (e.n_edges, e.src_nodes, e.weight_quantiles) == (0, 0, None)
    assert K.estimates(K.merge_steps(K.step_sketches(df, "n_edges", "src", "dst", "w"))).first().n_edges == 3


def test_the_check_can_fail():
    rnd = random.Random(1)
    values = [rnd.random() for _ in range(2000)]
    assert _rank_off(values, sorted(values)[1100], 0.5) > 2 * K.rank_error()


def test_the_check_joins_the_tables_once(spark):
    """Exact counts and ranks come from the written transfers, distinct payers from what is distinct in a month."""
    from conftest import SF001
    from ringlens.plans import catalog

    out = catalog.q_step_sketches(spark, SF001)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_custkey" not in plan
    assert "Expand" not in plan
    rows = out.collect()
    assert rows and all(r[c] for r in rows for c in out.columns if c.endswith("_kept"))
