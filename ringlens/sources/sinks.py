"""Table sinks: the prepared edge table (Parquet) and the report tables behind the reference's charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORE_EXTRACT_COLUMNS = [
    "cluster",
    "n_nodes",
    "n_edges",
    "internal_density",
    "coeff_variation",
    "fraud_score",
    "is_fraud_ring",
    "total_volume",
]


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def score_extract(scored_clusters: DataFrame) -> DataFrame:
    """The eight columns of the cluster-score report, best score first."""
    return scored_clusters.select(*SCORE_EXTRACT_COLUMNS).orderBy(F.desc("fraud_score"), F.asc("cluster"))


def write_csv(df: DataFrame, path: str) -> None:
    """Distributed CSV write with a header (one file per task; no driver-side pandas)."""
    df.write.mode("overwrite").option("header", "true").csv(path)
