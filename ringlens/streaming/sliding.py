"""The transfer graph of a sliding event-time window, from a stream of transfers.

Each transfer belongs to every window of ``window`` length, one starting every ``slide``, that covers its time. A window's edges are those
of the batch operator :func:`ringlens.operators.edges.canonical_pairs` on its transfers, with their number and volume. The state is one
row per pair, label and open window: a window is written once, when the watermark (the latest time seen less ``lateness``) has passed its
end, and its state is dropped then. A transfer delivered again is removed before it is counted: source, destination, weight, label and time
name a transfer, and its state lives until the watermark has passed its time by ``lateness``.

Late rows: a transfer whose time the watermark has passed is dropped, before it reaches any window, and counted by Spark in the progress
of the query (:func:`dropped_rows`). Transfers without a time belong to no window. What a delivery adds to the
watermark holds from the delivery after it on, so the result follows from the order of deliveries alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ringlens.operators.edges import select_edge_roles

TRANSFER_KEY = ["src_key", "dst_key", "weight", "true_label", "time"]


def _instant(col: Column, kind: T.DataType) -> Column:
    """A watermark needs instants: a time without zone is taken as UTC."""
    if not isinstance(kind, T.TimestampNTZType):
        return col
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), col))


def _as_given(col: Column, kind: T.DataType) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), _epoch()) if isinstance(kind, T.TimestampNTZType) else col


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def require_timestamp(rows: DataFrame, time_col: str) -> T.DataType:
    kind = rows.schema["time"].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"time column {time_col} must be a timestamp")
    return kind


def micros(span: str) -> Column:
    """A span of days or less as microseconds."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _epoch() + F.expr(f"INTERVAL '{span}'"))


def instant_micros(col: Column, kind: T.DataType) -> Column:
    """A time of type ``kind`` as microseconds since 1970 in UTC."""
    return F.unix_micros(_instant(col, kind))


def sliding_edges(
    raw_stream: DataFrame,
    source_col: str = "src",
    destination_col: str = "dst",
    weight_col: str | None = "weight",
    label_col: str | None = "true_label",
    time_col: str = "time",
    window: str = "7 days",
    slide: str = "1 day",
    lateness: str = "1 day",
) -> DataFrame:
    """``window_start, window_end, src, dst, true_label, weight (largest), n_transfers, volume`` of every window.

    Works on a stream (then only closed windows appear) and, for the same rows without late ones, on a table. A time without zone is taken as
    UTC, and the windows' ends are without zone then. Windows begin at whole multiples of ``slide`` since 1970 in UTC.
    """
    rows = select_edge_roles(raw_stream, source_col, destination_col, weight_col, label_col, time_col).filter("time is not null")
    kind = require_timestamp(rows, time_col)
    rows = rows.withColumn("time", _instant(F.col("time"), kind))
    if rows.isStreaming:
        rows = rows.withWatermark("time", lateness).dropDuplicatesWithinWatermark(TRANSFER_KEY)
    else:
        rows = rows.dropDuplicates(TRANSFER_KEY)
    lo, hi = F.least("src_key", "dst_key").alias("src"), F.greatest("src_key", "dst_key").alias("dst")
    edges = rows.filter(F.col("src_key") != F.col("dst_key")).groupBy(F.window("time", window, slide).alias("window"), lo, hi, "true_label")
    return edges.agg(
        F.max("weight").alias("weight"), F.count(F.lit(1)).alias("n_transfers"), F.sum("weight").alias("volume")
    ).select(
        _as_given(F.col("window.start"), kind).alias("window_start"), _as_given(F.col("window.end"), kind).alias("window_end"),
        "src", "dst", "true_label", "weight", "n_transfers", "volume",
    )


def start_sliding_graph(edges_stream: DataFrame, out_path: str, checkpoint_location: str, available_now: bool = True) -> StreamingQuery:
    """Append the edges of closed windows to ``out_path``, each window once whatever fails and is run again."""
    writer = edges_stream.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")).start()


def read_sliding_graph(spark: SparkSession, edges_stream: DataFrame, out_path: str) -> DataFrame:
    """The edges of all windows closed so far (none, if none was)."""
    return spark.read.schema(edges_stream.schema).parquet(out_path)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped in this run of the query, by the progress that Spark keeps of it."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
