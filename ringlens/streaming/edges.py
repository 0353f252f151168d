"""Edge preparation on a stream of edge files (Structured Streaming).

The same role cleaning and undirected max-dedupe as the batch path, as a stateful streaming aggregation in
``update`` mode. Each micro-batch appends the pairs whose max changed to a Parquet folder in the shared
storage. Taking the max again when reading is idempotent, so a micro-batch replayed after a failure cannot
change the result: the folder read through :func:`read_ingested_pairs` equals the batch
:func:`ringlens.operators.edges.canonical_pairs` on the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringlens.operators.edges import canonical_pairs, select_edge_roles


def canonical_pair_stream(
    raw_stream: DataFrame,
    source_col: str = "src",
    destination_col: str = "dst",
    weight_col: str | None = "weight",
    label_col: str | None = "true_label",
) -> DataFrame:
    """Streaming ``src, dst, weight, true_label`` (string keys, max weight per pair and label)."""
    selected = select_edge_roles(raw_stream, source_col, destination_col, weight_col, label_col)
    return canonical_pairs(selected, "src_key", "dst_key")


def start_pair_ingest(
    pairs_stream: DataFrame, out_path: str, checkpoint_location: str, available_now: bool = True
) -> StreamingQuery:
    """Start the ingest; ``available_now`` processes what is there and stops (else every 30 seconds)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = (
        pairs_stream.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_ingested_pairs(spark: SparkSession, out_path: str) -> DataFrame:
    """The current canonical pairs: max over every update written so far."""
    return (
        spark.read.parquet(out_path)
        .groupBy("src", "dst", "true_label")
        .agg(F.max("weight").alias("weight"))
        .select("src", "dst", "weight", "true_label")
    )
