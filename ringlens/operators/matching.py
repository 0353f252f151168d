"""The same cluster in two clusterings: overlap of node sets, mutual best matches, births and deaths.

Cluster ids of two runs have nothing to do with each other. Two clusters are the same if each is the other's best match by the Jaccard
similarity of their nodes. One join by node and one grouped count give all overlaps, at most one row per node; the best of
a cluster is a minimum over its overlaps, which combines before the shuffle, so a cluster with most of the nodes is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.operators.clusters import cluster_sizes
from ringlens.plans.runtime import materialize


def cluster_overlaps(before: DataFrame, after: DataFrame) -> DataFrame:
    """``old_cluster, new_cluster, common, old_nodes, new_nodes, jaccard`` of clusters that share a node.

    ``before`` and ``after`` are assignments ``id, cluster``, one row per node; nodes without a cluster are left out.
    """
    old = before.filter("cluster is not null").select("id", F.col("cluster").alias("old_cluster"))
    new = after.filter("cluster is not null").select("id", F.col("cluster").alias("new_cluster"))
    common = old.join(new, "id").groupBy("old_cluster", "new_cluster").agg(F.count(F.lit(1)).alias("common"))
    old_sizes = cluster_sizes(before).select(F.col("cluster").alias("old_cluster"), F.col("n_nodes").alias("old_nodes"))
    new_sizes = cluster_sizes(after).select(F.col("cluster").alias("new_cluster"), F.col("n_nodes").alias("new_nodes"))
    union = F.col("old_nodes") + F.col("new_nodes") - F.col("common")
    return common.join(old_sizes, "old_cluster").join(new_sizes, "new_cluster").select(
        "old_cluster", "new_cluster", "common", "old_nodes", "new_nodes", (F.col("common") / union).alias("jaccard")
    )


def match_clusters(before: DataFrame, after: DataFrame, min_jaccard: float = 0.0) -> DataFrame:
    """Every cluster of both runs once: ``status, old_cluster, new_cluster, common, old_nodes, new_nodes, jaccard``.

    ``kept``: each is the other's best match (ties: the smaller id) and their Jaccard is at least ``min_jaccard``; ``died``: an old
    cluster without match; ``born``: a new one without.
    """
    overlaps = materialize(cluster_overlaps(before, after), "cluster-overlaps")
    # of equal Jaccards the smaller id: the overlaps are ratios of counts, so equal ones are equal doubles
    best_new = overlaps.groupBy("old_cluster").agg(F.min(F.struct(-F.col("jaccard"), F.col("new_cluster").alias("c"))).alias("best"))
    best_old = overlaps.groupBy("new_cluster").agg(F.min(F.struct(-F.col("jaccard"), F.col("old_cluster").alias("c"))).alias("best"))
    mutual = best_new.select("old_cluster", F.col("best.c").alias("new_cluster")).join(
        best_old.select("new_cluster", F.col("best.c").alias("old_cluster")), ["old_cluster", "new_cluster"]
    )
    kept = materialize(overlaps.join(mutual, ["old_cluster", "new_cluster"]).filter(F.col("jaccard") >= min_jaccard), "cluster-matches")
    shape = ["status", "old_cluster", "new_cluster", "common", "old_nodes", "new_nodes", "jaccard"]
    zero, none = F.lit(0).cast("long"), F.lit(0.0)

    def alone(assignments: DataFrame, side: str, other: str, status: str) -> DataFrame:
        own, theirs = f"{side}_cluster", f"{other}_cluster"
        sizes = cluster_sizes(assignments.filter("cluster is not null")).select(F.col("cluster").alias(own), F.col("n_nodes").alias(f"{side}_nodes"))
        left = sizes.join(kept.select(own), own, "left_anti")
        empty = F.lit(None).cast(kept.schema[theirs].dataType)
        return left.withColumns({"status": F.lit(status), theirs: empty, "common": zero, f"{other}_nodes": zero, "jaccard": none}).select(*shape)

    return (
        kept.withColumn("status", F.lit("kept")).select(*shape)
        .union(alone(before, "old", "new", "died")).union(alone(after, "new", "old", "born"))
    )


def carry_identity(identity: DataFrame, matches: DataFrame) -> DataFrame:
    """``new_cluster, identity`` for the clusters of the later run: a kept cluster takes its old one's identity, a born one the next free number,
    in the order of its id.

    ``identity`` is (old_cluster, identity) of the earlier run. Both tables have one row per cluster.
    """
    from ringlens.operators.ranking import global_positions

    kept = matches.filter("status = 'kept'").select("old_cluster", "new_cluster").join(identity, "old_cluster").select("new_cluster", "identity")
    top = identity.agg(F.coalesce(F.max("identity"), F.lit(-1))).scalar()
    born = global_positions(matches.filter("status = 'born'").select("new_cluster"), ["new_cluster"], "nth")
    return kept.union(born.select("new_cluster", (top + 1 + F.col("nth")).cast(identity.schema["identity"].dataType).alias("identity")))
