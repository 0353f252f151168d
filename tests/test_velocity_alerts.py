"""Recent activity against brute force, composite weights, the alert table's replays, and drift against the plain recursion."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ringlens.operators import alerts as A
from ringlens.operators import velocity as W

SCHEMA = "payer string, t long, amount double"


def _rows(n=900):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.4 else f"p{rnd.randint(1, 12)}", rnd.randint(-500, 3000), round(rnd.uniform(0, 50), 2)) for _ in range(n)]
    return rows + [("edge", t, 1.0) for t in (0, 100, 100, 200, 201, 400, 800)] + [(None, 5, 1.0), ("", 5, 1.0), ("x", None, 1.0), ("odd", 7, None), ("odd", 8, float("nan")), ("odd", 9, -4.0)]


def _brute(rows, window):
    of = defaultdict(list)
    for p, t, a in rows:
        if p and t is not None:
            of[p].append((t, Decimal(str(a)) if a is not None and a == a and a > 0 else Decimal(0)))
    out = {}
    for p, ts in of.items():
        for t in {t for t, _ in ts}:
            inside = [x for x in ts if t - window <= x[0] <= t]
            now = sum(x[0] == t for x in ts)
            gaps = [t - x[0] for x in inside if x[0] < t]
            out[p, t] = (now, len(inside), sum(x[1] for x in inside), 0 if now > 1 else min(gaps, default=None))
    return out


@pytest.mark.parametrize("bucket", [None, 100, 137, 100_000])
def test_recent_activity_equals_brute_force(spark, bucket):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.payer, r["at"]): (r.n_now, r.n_recent, r.amount_recent, r.gap) for r in W.recent_activity(df, "payer", "t", "amount", 100, bucket).collect()}
    assert got == _brute(rows, 100)


def test_hot_payer_is_dealt_into_bounded_buckets(spark):
    """A third of all rows is one payer's: no group of the running sum holds more than three rows a second of a bucket."""
    hot = spark.range(60_000).select(F.lit("hot").alias("payer"), (F.col("id") % 20_000).alias("t"), F.lit(1.0).alias("amount"))
    rest = spark.range(120_000).select(F.concat(F.lit("p"), F.col("id") % 999).alias("payer"), F.col("id").alias("t"), F.lit(1.0).alias("amount"))
    out = W.recent_activity(hot.union(rest), "payer", "t", "amount", 60, 200).filter("payer = 'hot'")
    assert out.agg(F.count("*"), F.min("n_recent"), F.max("n_recent")).first()[:] == (20_000, 3, 183)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(payer" in plan and "Python" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        W.recent_activity(hot, "payer", "t", "amount", 60, 59)


def test_times_of_all_types(spark):
    df = spark.sql("SELECT 'a' AS payer, 1.0D AS amount, TIMESTAMP_NTZ'1970-01-02 00:00:01' AS n, TIMESTAMP'1970-01-02 00:00:01Z' AS z, DATE'1970-01-02' AS d, 86401.9D AS f, 86401 AS i")
    assert [W.recent_activity(df, "payer", c, "amount", 10).first()["at"] for c in "nzdfi"] == [86401, 86401, 86400, 86401, 86401]
    with pytest.raises(TypeError):
        W.recent_activity(df, "payer", "payer", "amount", 10)


def test_composite_weights(spark):
    rows = [(1, "a", 0, 10.0, 0.5), (2, "a", 50, 20.0, 2.0), (3, "a", 51, 40.0, None), (4, "b", 9, 40.0, 1.0), (5, None, 9, 40.0, 1.0), (6, "b", None, 0.0, -1.0), (7, "c", 1, 1.0, 0.0), (7, "c", 1, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, payer string, at long, amount double, weight double")  # names that the job uses itself
    cfg = W.CompositeWeight(0.4, 0.3, 0.2, 0.1, window_seconds=100, fast_count=3, fast_amount=1000.0)
    out = W.composite_weights(df, "payer", "at", "amount", F.col("weight"), cfg)
    assert out.columns[:4] == ["id", "payer", "at", "amount"] and out.count() == len(rows)
    got = {r.id: (r.n_recent, r.time_proximity, r.place_closeness, r.velocity_flag, round(r.weight, 9)) for r in out.collect()}
    assert got == {
        1: (1, 0.0, 0.5, 0.0, 0.2), 2: (2, 0.5, 1.0, 0.0, 0.55), 3: (3, 0.99, 0.0, 1.0, 0.797), 4: (1, 0.0, 1.0, 0.0, 0.6), 5: (0, 0.0, 1.0, 0.0, 0.6),
        6: (0, 0.0, 0.0, 0.0, 0.0), 7: (2, 1.0, 0.0, 0.0, 0.31),
    }
    assert W.composite_weights(df.limit(0), "payer", "at", "amount", F.lit(1)).count() == 0


def _flags(spark, rows):
    return spark.createDataFrame(rows, "ring long, score double")


def test_alert_table_replays_and_empty_days(spark, tmp_path):
    path = str(tmp_path / "alerts")
    new = lambda day, rows: sorted(r.ring for r in A.publish_alerts(_flags(spark, rows), "ring", day, path).collect())
    assert new("2024-01-01", [(1, 0.9), (2, 0.8), (None, 0.1)]) == [1, 2]
    assert new("2024-01-02", [(2, 0.7), (3, 0.6), (3, 0.5)]) == [3]
    before = sorted(A.read_alerts(spark, "ring", path).collect())
    assert new("2024-01-02", [(2, 0.7), (3, 0.6), (3, 0.5)]) == [3]  # the same run again: the same answer and table
    assert sorted(A.read_alerts(spark, "ring", path).collect()) == before
    day = lambda n: dt.date(2024, 1, n)
    assert [tuple(r) for r in before] == [
        (1, day(1), day(1), 1, False, 0.9), (2, day(1), day(2), 2, True, 0.7), (3, day(2), day(2), 1, True, 0.5)]
    assert new("2024-01-02", []) == []  # corrected to no flags: the day's rows go
    assert [r[:5] for r in map(tuple, sorted(A.read_alerts(spark, "ring", path).collect()))] == [(1, day(1), day(1), 1, False), (2, day(1), day(1), 1, False)]
    assert new("2023-12-31", [(2, 0.4)]) == [2]  # a day filled in later
    assert {r.ring: r.first_seen for r in A.read_alerts(spark, "ring", path).collect()}[2] == dt.date(2023, 12, 31)


def test_drift_equals_the_recursion(spark):
    rnd = random.Random(8)
    rows = [(t, c, None if (t, c) == (7, 1) else rnd.gauss(0.5 - (0.2 if c == 2 and t > 10 else 0), 0.03)) for c in (1, 2) for t in range(30)]
    out = A.drift(spark.createDataFrame(rows, "slice int, cluster int, v double"), "v", 5, 0.05, 0.4).orderBy("cluster", "slice").collect()
    want = []
    for c in (1, 2):
        vs = [v for _, k, v in rows if k == c]
        mean, down, up = sum(vs[:5]) / 5, 0.0, 0.0
        for v in vs:
            down, up = (max(0.0, down + mean - v - 0.05), max(0.0, up + v - mean - 0.05)) if v is not None else (down, up)
            want.append((pytest.approx(down), pytest.approx(up), max(down, up) > 0.4))
    assert [(r.cusum_down, r.cusum_up, r.alarm) for r in out] == want
    assert {r.cluster for r in out if r.alarm} == {2} and out[0].change is None
    flat = A.drift(spark.createDataFrame([(t, 1, 0.25) for t in range(9)], "slice int, cluster int, v double"), "v", 3, 0.0, 0.0).collect()
    assert not any(r.alarm for r in flat)


def test_sliced_density(spark):
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 1, 1), (1, 2, 3), (1, 3, 9), (2, 1, 4)], "slice int, src long, dst long")
    named = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (4, 8), (9, None)], "id long, cluster int")
    got = sorted(tuple(r) for r in A.sliced_density(edges, named).collect())
    assert got == [(1, 7, 3, 2, pytest.approx(2 / 3)), (2, 7, 1, 0, 0.0), (2, 8, 1, 0, 0.0)]
