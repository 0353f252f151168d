from ringlens.streaming.edges import canonical_pair_stream, read_ingested_pairs, start_pair_ingest
from ringlens.streaming.recluster import publish_batch, published_batches, read_published, start_reclustering
from ringlens.streaming.sliding import dropped_rows, read_sliding_graph, sliding_edges, start_sliding_graph

__all__ = [
    "canonical_pair_stream", "dropped_rows", "publish_batch", "published_batches", "read_ingested_pairs", "read_published", "read_sliding_graph",
    "sliding_edges", "start_pair_ingest", "start_reclustering", "start_sliding_graph",
]
