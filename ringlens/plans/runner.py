"""End-to-end runs: read or generate edges, optional annealing, clustering, metrics, scores, evaluation, summary.

Returns tables, not driver dicts. The few intermediates that every later step reads (edges and assignments)
are written once to the shared folder; the rest stays lazy so Catalyst sees whole plans.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.config import ClusterConfig, PipelineConfig
from ringlens.operators import clusters as C
from ringlens.operators import edges as E
from ringlens.operators import evaluate as V
from ringlens.operators import heat as H
from ringlens.operators import pic as P
from ringlens.operators import rings as R
from ringlens.operators import summary as S
from ringlens.plans.runtime import materialize
from ringlens.sources.readers import read_edge_file


def analyze_edges(edges: DataFrame, cfg: ClusterConfig | None = None, clusterer: str = "mllib",
                  assignments: DataFrame | None = None, labelled_only: bool = False) -> dict[str, DataFrame]:
    """Cluster canonical edges (unless ``assignments`` are given) and derive every cluster table."""
    cfg = cfg or ClusterConfig()
    started = time.time()
    own = assignments is None
    if own:
        if clusterer == "mllib":
            assignments = P.run_pic(edges, cfg)
        elif clusterer == "dataframe":
            assignments = P.dataframe_pic(edges, cfg)
        else:
            raise ValueError("clusterer must be 'mllib' or 'dataframe'")
        assignments = materialize(assignments, "assignments")
    elapsed = time.time() - started
    enriched = C.enrich_edges(edges, assignments)
    intra = C.intra_cluster_edges(enriched)
    metrics = C.cluster_metrics_from_parts(C.cluster_sizes(assignments), C.cluster_edge_stats(intra))
    scored = C.score_clusters(metrics, cfg)
    results, evaluation = V.evaluate_predictions(edges, assignments, scored, labelled_only=labelled_only)
    # the number of clusters is bounded by k only if they were made here
    summary = S.run_summary(edges, scored, results, evaluation, list_ids=own).withColumns(
        {"elapsed_seconds": F.lit(round(elapsed, 2)), "pic_partitions": F.lit(cfg.pic_partitions)}
    )
    return {
        "assignments": assignments,
        "enriched": enriched,
        "intra": intra,
        "metrics": metrics,
        "scored": scored,
        "node_results": results,
        "evaluation": evaluation,
        "summary": summary,
    }


def run_pipeline(
    spark: SparkSession,
    cfg: PipelineConfig | None = None,
    input_path: str | None = None,
    input_format: str = "parquet",
    source_col: str = "src",
    destination_col: str = "dst",
    weight_col: str | None = "weight",
    label_col: str | None = "true_label",
    time_col: str | None = None,
    time_min=None,
    time_max=None,
    input_has_header: bool = True,
    input_delimiter: str = ",",
    input_df: DataFrame | None = None,
    clusterer: str = "mllib",
) -> dict[str, DataFrame]:
    """The reference's ``run_pipeline`` as tables. An empty-string column role switches that role off.

    Input: ``input_df``, or a file at ``input_path`` (csv/json/parquet/any format), or, with neither, the
    synthetic graph with planted rings. The session is the caller's: it is neither created nor stopped here.
    """
    cfg = cfg or PipelineConfig()
    weight_col = weight_col or None
    label_col = label_col or None
    time_col = time_col or None
    if input_df is None and input_path:
        roles = [c for c in (source_col, destination_col, weight_col, label_col, time_col) if c]
        # JSON without a schema would be read once just to infer one: the role columns are read as text instead
        schema = ", ".join(f"`{c}` string" for c in dict.fromkeys(roles)) if input_format.lower() == "json" else None
        input_df = read_edge_file(spark, input_path, input_format, input_has_header, input_delimiter, schema)
    if input_df is not None:
        edges = E.prepare_edges(
            input_df, source_col, destination_col, weight_col, label_col, time_col, time_min, time_max,
            one_edge_per_pair=cfg.one_edge_per_pair,
        )
    else:
        edges = E.prepare_typed_edges(R.synthetic_graph(spark, cfg.generator), cfg.one_edge_per_pair)
    edges = materialize(edges, "edges")
    out: dict[str, DataFrame] = {}
    if cfg.use_heat_kernel:
        heat = H.apply_heat_kernel(edges, cfg.heat)
        out.update(
            {
                "heat_history": heat["history"],
                "heat_frames": heat["frames"],
                "node_risk": heat["node_risk"],
                "heat_metadata": heat["metadata"],
            }
        )
        edges = materialize(heat["edges"], "annealed-edges")
    out["edges"] = edges
    out.update(analyze_edges(edges, cfg.cluster, clusterer, labelled_only=cfg.labelled_only))
    return out
