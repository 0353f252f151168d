"""Clusters of the newest closed window, batch by batch, published exactly once.

Each micro-batch of a stream of windowed edges (:func:`ringlens.streaming.sliding.sliding_edges`) holds the windows that have just closed. The
newest of them is clustered, and its tables are written to a folder of the batch. A batch is published by one empty marker file,
created last; readers open the folders of published batches only. A batch that is run again after a failure finds its marker and
writes nothing, or finds none and writes its folder anew, so what readers see never changes and never is half a batch.

A stream of transfers needs no windows but the newest. Spark's state would hold a row of every transfer of a delivery, and one of every pair
and window, in the executors' memory until the watermark has passed them, though most of a long delivery is passed with its end. So
the transfers that are not done with are a table here, written and published with each batch (``open``, beside ``progress``), and
:func:`ringlens.streaming.sliding.sliding_edges` makes the newest closed window of that table and the batch. Late and repeated transfers
are dropped as in a stream of windowed edges.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ringlens.operators.edges import build_node_index, index_pairs, select_edge_roles, with_weight_norm
from ringlens.plans.runtime import materialize
from ringlens.streaming.sliding import TRANSFER_KEY, instant_micros, micros, require_timestamp, sliding_edges

# A clusterer takes canonical edges (src, dst long, weight, true_label, weight_norm) and gives tables by name.
Clusterer = Callable[[DataFrame], dict[str, DataFrame]]
MARKERS = "_published"


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def published_batches(spark: SparkSession, out_path: str) -> list[int]:
    """Numbers of the published batches, ascending."""
    folder, fs = _path(spark, f"{out_path}/{MARKERS}")
    if not fs.exists(folder):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder))


def publish_batch(spark: SparkSession, out_path: str, batch_id: int, tables: Callable[[], dict[str, DataFrame]]) -> bool:
    """Write the tables of a batch and publish them; False, and ``tables`` is not called, if the batch is published already."""
    marker, fs = _path(spark, f"{out_path}/{MARKERS}/{batch_id}")
    if fs.exists(marker):
        return False
    for name, table in tables().items():
        table.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}/{name}")
    fs.create(marker, True).close()
    return True


def read_published(spark: SparkSession, out_path: str, name: str) -> DataFrame | None:
    """Table ``name`` of all published batches, with ``batch``; None before the first one that has it."""
    parts = []
    for batch in published_batches(spark, out_path):
        folder, fs = _path(spark, f"{out_path}/batch={batch}/{name}")
        if fs.exists(folder):
            parts.append(spark.read.parquet(f"{out_path}/batch={batch}/{name}").select(F.lit(batch).cast("long").alias("batch"), "*"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def cluster_newest_window(edges: DataFrame, clusterer: Clusterer) -> dict[str, DataFrame]:
    """The clusterer's tables for the newest window of ``edges``, each with ``window_end``; a column ``id`` becomes the node's key."""
    newest = edges.agg(F.max("window_end")).first()[0]
    if newest is None:
        return {}
    window = edges.filter(F.col("window_end") == F.lit(newest).cast(edges.schema["window_end"].dataType))
    pairs = materialize(window.select("src", "dst", "weight", "true_label"), "window-pairs")
    index = materialize(build_node_index(pairs), "window-index")
    tables = clusterer(materialize(with_weight_norm(index_pairs(pairs, index), pairs), "window-edges"))
    stamp = F.lit(newest).cast(edges.schema["window_end"].dataType).alias("window_end")

    def keyed(table: DataFrame) -> DataFrame:
        if "id" not in table.columns:
            return table.select(stamp, "*")
        rest = [c for c in table.columns if c != "id"]
        return table.join(index.withColumnRenamed("node_id", "id"), "id").select(stamp, "node_key", *rest)

    return {name: keyed(table) for name, table in tables.items()}


def _transfers(raw: DataFrame, source_col="src", destination_col="dst", weight_col="weight", label_col="true_label", time_col="time", **_) -> DataFrame:
    rows = select_edge_roles(raw, source_col, destination_col, weight_col, label_col, time_col).filter("time is not null")
    require_timestamp(rows, time_col)
    return rows


def _batch_before(spark: SparkSession, out_path: str, batch_id: int) -> int | None:
    return max((b for b in published_batches(spark, out_path) if b < batch_id), default=None)


def _drop_open(spark: SparkSession, out_path: str, batch: int | None) -> None:
    """Delete the open transfers of a batch, once the next one is published."""
    if batch is not None:
        folder, fs = _path(spark, f"{out_path}/batch={batch}/open")
        fs.delete(folder, True)


def cluster_next_window(
    spark: SparkSession, batch: DataFrame, batch_id: int, clusterer: Clusterer, out_path: str, window: str = "7 days", slide: str = "1 day", lateness: str = "1 day"
) -> dict[str, DataFrame]:
    """The clusterer's tables for the newest window that a batch of transfers closes, none if it closes none, and what the next batch needs:
    ``progress`` (the watermark in microseconds since 1970, which it begins with, and the batch's late transfers) and ``open``, the transfers
    of windows that are not closed."""
    time = instant_micros(F.col("time"), batch.schema["time"].dataType)
    last = _batch_before(spark, out_path, batch_id)
    passed = 0 if last is None else spark.read.parquet(f"{out_path}/batch={last}/progress").first()["watermark"]
    seen = batch.agg(F.max(time).alias("top"), F.count_if(time <= passed).alias("n_late")).select("*", micros(lateness).alias("late"), micros(window).alias("span")).first()
    # milliseconds, as Spark's
    watermark = passed if seen["top"] is None else max(passed, seen["top"] // 1000 * 1000 - seen["late"])
    rows = batch.filter(time > passed)
    if last is not None:
        rows = rows.unionByName(spark.read.parquet(f"{out_path}/batch={last}/open"))

    def edges(of: DataFrame) -> DataFrame:
        return sliding_edges(of, "src_key", "dst_key", window=window, slide=slide)

    # the newest window with an edge: repeated transfers do not change it
    ends = instant_micros(F.window(F.timestamp_micros(time), window, slide)["end"], T.TimestampType())
    closed = rows.filter(F.col("src_key") != F.col("dst_key")).select(ends.alias("end")).filter((F.col("end") > passed) & (F.col("end") <= watermark))
    newest = closed.agg(F.max("end")).first()[0]
    tables = {}
    if newest is not None:
        found = edges(rows.filter((time >= newest - seen["span"]) & (time < newest)))
        found = found.filter(instant_micros(F.col("window_end"), found.schema["window_end"].dataType) == newest)
        tables = cluster_newest_window(materialize(found, "closed-window"), clusterer)
    progress = spark.createDataFrame([(watermark, seen["n_late"])], "watermark long, n_late long")
    return tables | {"open": rows.filter(time > watermark - seen["span"]).dropDuplicates(TRANSFER_KEY), "progress": progress}


def start_reclustering(
    edges_stream: DataFrame, clusterer: Clusterer, out_path: str, checkpoint_location: str, available_now: bool = True, every: str = "1 hour",
    windows: dict[str, str] | None = None,
) -> StreamingQuery:
    """Cluster the newest closed window of every micro-batch (one every ``every``, or all that is there) and publish the tables.

    ``windows``: the arguments of :func:`ringlens.streaming.sliding.sliding_edges`, if the stream is one of transfers instead of windowed edges."""
    if windows is not None:
        edges_stream = _transfers(edges_stream, **windows)
    spans = {k: v for k, v in (windows or {}).items() if k in ("window", "slide", "lateness")}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def tables() -> dict[str, DataFrame]:
            if windows is not None:
                return cluster_next_window(spark, batch, batch_id, clusterer, out_path, **spans)
            return cluster_newest_window(materialize(batch, "closed-windows"), clusterer)

        if publish_batch(spark, out_path, batch_id, tables) and windows is not None:
            _drop_open(spark, out_path, _batch_before(spark, out_path, batch_id))

    writer = edges_stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()
