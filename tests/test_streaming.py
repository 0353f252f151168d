"""Streaming edge preparation equals the batch operator on the same rows."""

import tempfile

from pyspark.sql import functions as F

from ringlens.operators import edges as E
from ringlens.sources import testgraphs as G
from ringlens.streaming import canonical_pair_stream, read_ingested_pairs, start_pair_ingest

from conftest import SF001


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="ringlens-stream-", dir="/tmp")
    trades = G.trades(spark, SF001)
    # Three files arriving one after another (split by order date).
    for i, (lo, hi) in enumerate([("1990-01-01", "1997-01-01"), ("1997-01-01", "1999-01-01"), ("1999-01-01", "2100-01-01")]):
        part = trades.filter((F.col("order_date") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("order_date") < F.lit(hi).cast("timestamp_ntz")))
        part.write.parquet(f"{base}/in/part{i}")
    stream = (
        spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    )
    q = start_pair_ingest(
        canonical_pair_stream(stream, "src_key", "dst_key", "amount", "true_label"), f"{base}/out", f"{base}/ckpt"
    )
    q.awaitTermination(300)
    got = read_ingested_pairs(spark, f"{base}/out")
    want = E.canonical_pairs(E.select_edge_roles(trades, "src_key", "dst_key", "amount", "true_label"), "src_key", "dst_key")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
