"""Sliding windows and published re-clustering from streams: late and repeated rows, bounded state, failed and repeated batches."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from ringlens.operators.edges import canonical_pairs
from ringlens.streaming import recluster, sliding

SCHEMA = "payer string, payee string, amount double, booked timestamp, label string"
DAY0 = dt.datetime(2024, 1, 10)


def _at(days):
    return DAY0 + dt.timedelta(days=days)


def _stream(spark, base, deliveries, start, lateness="1 day", **windows):
    """Deliver the lists of rows one after the other; returns the edges' stream and the last run's query of each delivery."""
    queries = []
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        edges = sliding.sliding_edges(stream, "payer", "payee", "amount", "label", "booked", lateness=lateness, **windows)
        queries.append(start(edges, f"{base}/out", f"{base}/check"))
        queries[-1].awaitTermination(300)
    return edges, queries


def _brute(deliveries, lateness_days, days=7):
    """Rows kept by the watermark of earlier deliveries, repeated ones once, into daily windows; those that the last watermark has closed."""
    seen, newest, dropped, wins = set(), None, 0, {}
    for rows in deliveries:
        closes = newest and newest - dt.timedelta(days=lateness_days)
        for r in rows:
            payer, payee, amount, booked, label = r
            if booked is None or payer is None or payee is None:
                continue
            if closes and booked <= closes:
                dropped += 1
                continue
            if r in seen:
                continue
            seen.add(r)
            first = dt.datetime(booked.year, booked.month, booked.day)
            for back in range(days):
                begin = first - dt.timedelta(days=back)
                if payer != payee:
                    key = (begin, begin + dt.timedelta(days=days), min(payer, payee), max(payer, payee), label)
                    wins.setdefault(key, []).append(amount)
        newest = max([newest or dt.datetime.min, *[r[3] for r in rows if r[3]]])
    last = newest - dt.timedelta(days=lateness_days)
    return sorted((*k, max(v), len(v), sum(v)) for k, v in wins.items() if k[1] <= last), dropped


DELIVERIES = [
    [("a", "b", 5.0, _at(0), "x"), ("b", "a", 9.0, _at(0.5), "x"), ("a", "b", 5.0, _at(0), "x"), ("c", "c", 1.0, _at(1), "x"), ("a", None, 1.0, _at(1), "x")],
    [("a", "b", 5.0, _at(0), "x"), ("a", "c", 2.0, _at(9), "y"), ("c", "a", 3.0, None, "y"), ("a", "b", 7.0, _at(0.25), "x")],
    # the first is late by the second delivery's newest time, the second is not: its last window is open
    [("d", "e", 4.0, _at(2), "x"), ("d", "e", 4.0, _at(8.5), "x"), ("a", "c", 2.0, _at(9), "y"), ("e", "f", 1.0, _at(30), "z")],
    [("g", "h", 1.0, _at(31), "x"), ("d", "e", 4.0, _at(8.5), "x"), ("e", "f", 1.0, _at(30), "z"), ("a", "b", 1.5, _at(60), "x")],
]


def test_windows_equal_brute_force(spark):
    base = tempfile.mkdtemp(prefix="ringlens-slide-", dir="/tmp")
    edges, queries = _stream(spark, base, DELIVERIES, sliding.start_sliding_graph)
    got = sliding.read_sliding_graph(spark, edges, f"{base}/out").collect()
    want, dropped = _brute(DELIVERIES, 1)
    assert sorted(tuple(r) for r in got) == want and len(want) > 20
    # Spark counts a dropped row once where it meets the first stateful operator
    assert sum(sliding.dropped_rows(q) for q in queries) == dropped > 0


def test_a_delivery_twice_changes_nothing_and_state_stays_bounded(spark):
    days = [[(f"p{i}", f"q{i % 5}", 1.0 + i, _at(3 * d + i / 100), "x") for i in range(40)] for d in range(6)]
    results, sizes = [], []
    for feed in (days, [d for one in days for d in (one, one)]):
        base = tempfile.mkdtemp(prefix="ringlens-slide-", dir="/tmp")
        edges, queries = _stream(spark, base, feed, sliding.start_sliding_graph)
        results.append(sorted(tuple(r) for r in sliding.read_sliding_graph(spark, edges, f"{base}/out").collect()))
        sizes.append([sum(op["numRowsTotal"] for op in q.recentProgress[-1]["stateOperators"]) for q in queries])
    assert results[0] == results[1] == _brute(days, 1)[0]
    # open windows and transfers of the last days only: the state after six deliveries is that after three
    assert sizes[0][-1] <= sizes[0][2] and sizes[1][-1] <= sizes[0][2]


def test_stream_equals_batch_and_one_window_equals_the_batch_operator(spark):
    rows = [r for d in DELIVERIES for r in d]
    base = tempfile.mkdtemp(prefix="ringlens-slide-", dir="/tmp")
    edges, _ = _stream(spark, base, [rows, [("z", "zz", 1.0, _at(200), "x")]], sliding.start_sliding_graph)
    batch = sliding.sliding_edges(spark.createDataFrame(rows, SCHEMA), "payer", "payee", "amount", "label", "booked")
    got = sliding.read_sliding_graph(spark, edges, f"{base}/out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    end = _at(5).replace(hour=0)
    one = batch.filter(F.col("window_end") == F.lit(end)).select("src", "dst", "weight", "true_label")
    inside = spark.createDataFrame([r for r in rows if r[3] and end - dt.timedelta(days=7) <= r[3] < end and r[1]], SCHEMA)
    pairs = canonical_pairs(inside.selectExpr("payer src", "payee dst", "amount weight", "label true_label"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, pairs.collect())) and one.count() > 0


def test_time_without_zone_and_wrong_types(spark):
    rows = spark.createDataFrame([("a", "b", 1.0, _at(0))], "src string, dst string, weight double, time timestamp_ntz")
    got = sliding.sliding_edges(rows, window="1 day").collect()
    assert [(r.window_start, r.window_end) for r in got] == [(_at(0), _at(1))]
    with pytest.raises(ValueError):
        sliding.sliding_edges(rows.withColumn("time", F.lit("2024")))
    with pytest.raises(ValueError):
        sliding.sliding_edges(rows.drop("time"))


def _sizes(edges):
    return {"sizes": edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"))}


def test_reclustering_publishes_each_batch_once(spark):
    base = tempfile.mkdtemp(prefix="ringlens-recluster-", dir="/tmp")
    calls, fail = [], [True]

    def clusterer(edges):
        calls.append(1)
        if len(calls) == 2 and fail[0]:
            raise RuntimeError("lost")
        return _sizes(edges)

    def start(edges, out, check):
        return recluster.start_reclustering(edges, clusterer, out, check)

    with pytest.raises(Exception, match="lost"):
        _stream(spark, base, DELIVERIES, start)
    before = recluster.published_batches(spark, f"{base}/out")
    first = sorted(map(tuple, recluster.read_published(spark, f"{base}/out", "sizes").collect()))
    fail[0] = False
    # the failed batch runs again from the checkpoint, with the deliveries after it
    _stream(spark, base, DELIVERIES[3:], start)
    after = sorted(map(tuple, recluster.read_published(spark, f"{base}/out", "sizes").collect()))
    assert recluster.published_batches(spark, f"{base}/out")[: len(before)] == before and after[: len(first)] == first
    assert len(after) > len(first)
    newest = {}
    for batch, end, *_ in after:
        newest.setdefault(batch, set()).add(end)
    assert all(len(ends) == 1 for ends in newest.values())


def test_publishing(spark):
    base = tempfile.mkdtemp(prefix="ringlens-publish-", dir="/tmp")
    table = spark.createDataFrame([(1, 2)], "a int, b int")
    assert recluster.published_batches(spark, base) == [] and recluster.read_published(spark, base, "t") is None
    # half a batch: written, not published
    table.write.parquet(f"{base}/batch=4/t")
    assert recluster.read_published(spark, base, "t") is None
    assert recluster.publish_batch(spark, base, 4, lambda: {"t": table.union(table)})
    assert not recluster.publish_batch(spark, base, 4, lambda: 1 / 0)
    assert recluster.publish_batch(spark, base, 11, lambda: {})
    assert recluster.published_batches(spark, base) == [4, 11]
    assert sorted(map(tuple, recluster.read_published(spark, base, "t").collect())) == [(4, 1, 2), (4, 1, 2)]


def test_newest_window(spark):
    rows = [(_at(0), "n1", "n2", 1.0, "x"), (_at(1), "n2", "n9", 4.0, "x"), (_at(1), "n5", "n9", 2.0, "y")]
    edges = spark.createDataFrame(rows, "window_end timestamp, src string, dst string, weight double, true_label string")
    got = recluster.cluster_newest_window(edges, lambda e: {"nodes": e.select(F.col("dst").alias("id"), "weight_norm"), "all": e.select("src", "dst")})
    assert sorted(map(tuple, got["nodes"].collect())) == [(_at(1), "n9", 0.5), (_at(1), "n9", 1.0)]
    assert sorted(map(tuple, got["all"].collect())) == [(_at(1), 0, 2), (_at(1), 1, 2)]
    assert recluster.cluster_newest_window(edges.limit(0), lambda e: 1 / 0) == {}


ROLES = {"source_col": "payer", "destination_col": "payee", "weight_col": "amount", "label_col": "label", "time_col": "booked"}


def _recluster(spark, base, deliveries, clusterer, windowed=False, schema=SCHEMA, **windows):
    """Deliver and recluster, from a stream of transfers or of windowed edges; the rows of the published table ``pairs``."""
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        if windowed:
            query = recluster.start_reclustering(sliding.sliding_edges(stream, **ROLES, **windows), clusterer, f"{base}/out", f"{base}/check")
        else:
            query = recluster.start_reclustering(stream, clusterer, f"{base}/out", f"{base}/check", windows=ROLES | windows)
        query.awaitTermination(300)
    found = recluster.read_published(spark, f"{base}/out", "pairs")
    return [] if found is None else [tuple(r) for r in found.drop("batch").collect()]


def _pairs(edges):
    return {"pairs": edges.select(F.col("src").alias("id"), "dst", "weight", "true_label")}


MORE_DELIVERIES = [
    # nothing closes; a loop's window has no edge; the newest closed window ends after the last transfer in it; no rows, or only late ones
    [[("a", "b", 5.0, _at(0), "x")], [("a", "b", 6.0, _at(0.75), None), ("a", "b", 6.0, _at(0.75), None)], [("c", "c", 1.0, _at(11), "x")]],
    [[("a", "b", 5.0, _at(0.1), "x"), ("a", "d", 2.0, _at(4), "x"), ("e", "f", 1.0, _at(9.2), "y")], [("a", "b", 1.0, _at(1), "x")], [("z", "y", 1.0, _at(40.5), "y")]],
    [[("a", None, 1.0, _at(50), "x"), ("c", "d", 1.0, None, "x")], [("a", "b", 1.0, _at(0), "x"), ("b", "c", 3.0, _at(20), "x")], [("d", "a", 2.0, _at(19), "x"), ("b", "c", 3.0, _at(20), "x"), ("q", "r", 4.0, _at(30), "y")]],
]


@pytest.mark.parametrize("deliveries", [DELIVERIES, *MORE_DELIVERIES])
@pytest.mark.parametrize("windows", [{}, {"lateness": "36 hours", "window": "3 days", "slide": "12 hours"}])
def test_transfers_give_the_windows_of_a_windowed_stream(spark, deliveries, windows):
    bases = [tempfile.mkdtemp(prefix="ringlens-transfers-", dir="/tmp") for _ in range(2)]
    want, got = (_recluster(spark, base, deliveries, _pairs, windowed, **windows) for base, windowed in zip(bases, (True, False), strict=True))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert want or deliveries is MORE_DELIVERIES[0]
    closes, late = None, 0
    for rows in deliveries:
        late += sum(1 for r in rows if r[3] and r[0] and r[1] and closes and r[3] <= closes)
        newest = max([r[3] for r in rows if r[3] and r[0] and r[1]], default=None)
        reach = newest and newest - (dt.timedelta(hours=36) if windows else dt.timedelta(days=1))
        closes = max(filter(None, (closes, reach)), default=None)
    assert recluster.read_published(spark, f"{bases[1]}/out", "progress").agg(F.sum("n_late")).first()[0] == late


def test_reclustering_transfers_keeps_no_state_of_closed_windows(spark):
    base = tempfile.mkdtemp(prefix="ringlens-transfers-", dir="/tmp")
    schema = SCHEMA.replace("timestamp", "timestamp_ntz")
    days = [[(f"p{i}", f"q{i % 5}", 1.0 + i, _at(200 * d + i), "x") for i in range(200)] for d in range(3)]
    got = _recluster(spark, base, [d for one in days for d in (one, one)], _pairs, schema=schema)
    stream = spark.readStream.schema(schema).parquet(f"{base}/in")
    # each delivery's newest closed window, once: its newest transfer is of day 199 at midnight, a day late, so that the window ends on day 198
    assert sorted({r[0] for r in got}) == [_at(200 * d + 198) for d in range(3)] and len(got) == 21
    batches = recluster.published_batches(spark, f"{base}/out")
    assert len(batches) == 6 and spark.read.parquet(f"{base}/out/batch={batches[-1]}/open").count() == 8
    assert recluster.read_published(spark, f"{base}/out", "open").count() == 8  # those of the batches before are gone
    with pytest.raises(ValueError):
        recluster.start_reclustering(stream.withColumn("booked", F.lit("2024")), _pairs, f"{base}/out3", f"{base}/check3", windows=ROLES)
    query = recluster.start_reclustering(stream, _pairs, f"{base}/out2", f"{base}/check2", windows=ROLES)
    query.awaitTermination(300)
    assert query.recentProgress and all(not p["stateOperators"] for p in query.recentProgress)


def test_a_failed_batch_of_transfers_runs_again(spark):
    base = tempfile.mkdtemp(prefix="ringlens-transfers-", dir="/tmp")
    calls = []

    def clusterer(edges):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return _pairs(edges)

    want = _recluster(spark, tempfile.mkdtemp(prefix="ringlens-transfers-", dir="/tmp"), DELIVERIES, _pairs)
    with pytest.raises(Exception, match="lost"):
        _recluster(spark, base, DELIVERIES, clusterer)
    done = len(recluster.published_batches(spark, f"{base}/out"))
    assert 0 < done < len(DELIVERIES)
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    recluster.start_reclustering(stream, clusterer, f"{base}/out", f"{base}/check", windows=ROLES).awaitTermination(300)
    got = _recluster(spark, base, DELIVERIES[done + 1:] or [[]], clusterer)
    assert sorted(got, key=str) == sorted(want, key=str)
