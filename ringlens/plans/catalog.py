"""Registered queries: one per operator group of the inventory, each reading the driver's tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` and has a DuckDB twin in :mod:`ringlens.plans.oracle` with the
same column names and the same rounding of doubles (sums in another order differ in the last bits).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringlens.config import ClusterConfig, GeneratorConfig, HeatConfig
from ringlens.functions.columns import repaired_weight, round_doubles
from ringlens.operators import alerts as A
from ringlens.operators import clusters as C
from ringlens.operators import edges as E
from ringlens.operators import etl as X
from ringlens.operators import evaluate as V
from ringlens.operators import heat as H
from ringlens.operators import matching as M
from ringlens.operators import one_dim as O
from ringlens.operators import pic as P
from ringlens.operators import rings as R
from ringlens.operators import sketches as K
from ringlens.operators import summary as S
from ringlens.operators import velocity as W
from ringlens.operators.ranking import global_positions
from ringlens.plans.runtime import materialize, scratch_path
from ringlens.sources import testgraphs as G
from ringlens.sources.readers import read_edge_file
from ringlens.sources.sinks import score_extract, write_csv
from ringlens.sources.tables import load_table
from ringlens.streaming import recluster, sliding

# Doubles whose magnitude reaches 1e7 are compared at 4 places, everything else at 6. Means of 2-decimal amounts
# are exact decimals that can end in a 5 at the 7th place (count divisible by 32), where the last bit of an
# order-dependent sum decides the rounding; they are compared at 4 places.
BIG = {
    "total_volume": 4,
    "std_weight": 4,
    "volume_per_node": 4,
    "flagged_volume": 4,
    "total_volume_flagged": 4,
    "avg_weight": 4,
}

TIME_SLICE = ("1996-01-01 00:00:00", "1997-12-31 00:00:00")
PI_STEPS = 6


def _rd(df: DataFrame, places: int = 6, **overrides: int) -> DataFrame:
    o = dict(BIG)
    o.update(overrides)
    return round_doubles(df, places, o)


# ---- graph inputs -------------------------------------------------------------------------------------------

def trade_edges(spark: SparkSession, sf_dir: str, **kw):
    return E.prepare_edges(G.trades(spark, sf_dir), "src_key", "dst_key", "amount", "true_label", **kw)


def co_supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.prepare_typed_edges(G.co_supply(spark, sf_dir), materialize_pairs=True)


def co_purchase_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.prepare_typed_edges(G.co_purchase(spark, sf_dir), materialize_pairs=True)


class ClusterRun:
    """Co-supply edges with the nation clustering and the tables derived from it. Each table is built on first
    use, so a query only runs (and writes) what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: ClusterConfig | None = None):
        self.cfg = cfg or ClusterConfig()
        self.edges = co_supply_edges(spark, sf_dir)
        self.assign = G.supplier_nation_assignments(spark, sf_dir, self.edges)
        self.enriched = C.enrich_edges(self.edges, self.assign)
        self.intra = C.intra_cluster_edges(self.enriched)
        self.stats = C.cluster_edge_stats(self.intra)

    @cached_property
    def metrics(self) -> DataFrame:
        return C.cluster_metrics_from_parts(C.cluster_sizes(self.assign), self.stats)

    @cached_property
    def scored(self) -> DataFrame:
        return C.score_clusters(self.metrics, self.cfg)

    @cached_property
    def _evaluated(self) -> tuple[DataFrame, DataFrame]:
        return V.evaluate_predictions(self.edges, self.assign, self.scored)

    @property
    def results(self) -> DataFrame:
        return self._evaluated[0]

    @property
    def evaluation(self) -> DataFrame:
        return self._evaluated[1]


# ---- edge preparation ---------------------------------------------------------------------------------------

def q_edge_prep(spark, sf_dir):
    return _rd(trade_edges(spark, sf_dir))


def q_node_index(spark, sf_dir):
    _, idx = trade_edges(spark, sf_dir, with_index=True)
    return idx.select("node_key", "node_id")


def q_time_slice(spark, sf_dir):
    return _rd(trade_edges(spark, sf_dir, time_col="order_date", time_min=TIME_SLICE[0], time_max=TIME_SLICE[1]))


def q_weight_repair(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    raw = li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("part"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("supp"),
        (F.col("l_quantity") - F.lit(25.0)).alias("raw_weight"),
        G.return_flag_label().alias("label"),
    )
    return _rd(E.select_edge_roles(raw, "part", "supp", "raw_weight", "label"))


def q_edge_dedupe(spark, sf_dir):
    raw = G.co_purchase(spark, sf_dir)
    base = raw.select("src", "dst", repaired_weight(F.col("weight")).alias("weight"), "true_label")
    return _rd(E.canonical_pairs(base))


def q_weight_norm(spark, sf_dir):
    return _rd(co_supply_edges(spark, sf_dir))


def _order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One edge per order: customer to one of 97 depots, with the order's date and price."""
    return load_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("payer"),
        F.concat(F.lit("00"), F.pmod("o_orderkey", F.lit(97)).cast("string")).alias("depot"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("booked"), F.col("o_orderstatus").alias("status"),
    )


def q_time_slice_text(spark, sf_dir):
    """A time slice of a CSV file, whose times are text."""
    path = scratch_path(spark, "orders-csv")
    write_csv(_order_edges(spark, sf_dir), path)
    raw = read_edge_file(spark, path, "csv")
    return _rd(E.prepare_edges(raw, "payer", "depot", "amount", "status", "booked", *TIME_SLICE))


def q_file_formats(spark, sf_dir):
    """The same edges read from CSV with another delimiter, JSON and Parquet: roles, repair and dedupe."""
    edges = _order_edges(spark, sf_dir)
    paths = {f: scratch_path(spark, f"orders-{f}") for f in ("csv", "json", "parquet")}
    edges.write.option("header", "true").option("delimiter", ";").csv(paths["csv"])
    edges.write.json(paths["json"])
    edges.write.parquet(paths["parquet"])
    out = None
    for fmt, path in paths.items():
        schema = "payer string, depot string, amount string, status string" if fmt == "json" else None
        raw = read_edge_file(spark, path, fmt, True, ";", schema)
        pairs = E.canonical_pairs(E.select_edge_roles(raw, "payer", "depot", "amount", "status"), "src_key", "dst_key")
        part = pairs.select(F.lit(fmt).alias("format"), "*")
        out = part if out is None else out.union(part)
    return _rd(out)


def q_dirty_edges(spark, sf_dir):
    """Rows with null and blank keys, and null, malformed, NaN, infinite and negative weights; no label column."""
    li = load_table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey").cast("string")
    raw = li.select(
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).when(F.col("l_orderkey") % 7 == 1, F.lit("   ")).otherwise(
            F.concat(F.lit("  P"), part, F.lit(" "))).alias("from"),
        F.when(F.col("l_suppkey") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("to"),
        F.element_at(F.array(*[F.lit(x) for x in ("NaN", "12abc", None, "-5.5", "Infinity", "0")], F.col("l_quantity").cast("string")),
                     (F.col("l_linenumber") % 7 + 1).cast("int")).alias("amount"),
    )
    return _rd(E.select_edge_roles(raw, "from", "to", "amount", "label"))


# ---- clusters, scores, evaluation, summary ------------------------------------------------------------------

def q_cluster_sizes(spark, sf_dir):
    edges = co_supply_edges(spark, sf_dir)
    return S.cluster_size_distribution(G.supplier_nation_assignments(spark, sf_dir, edges))


def q_cluster_edge_stats(spark, sf_dir):
    return _rd(ClusterRun(spark, sf_dir).stats)


def q_cluster_metrics(spark, sf_dir):
    return _rd(ClusterRun(spark, sf_dir).metrics)


def q_cluster_scores(spark, sf_dir):
    return _rd(ClusterRun(spark, sf_dir).scored)


def q_intra_cross(spark, sf_dir):
    return _rd(C.intra_cross_split(ClusterRun(spark, sf_dir).enriched))


def q_flagged_volume(spark, sf_dir):
    run = ClusterRun(spark, sf_dir)
    return _rd(C.flagged_volume(run.scored))


def q_node_results(spark, sf_dir):
    return _rd(ClusterRun(spark, sf_dir).results)


def q_confusion(spark, sf_dir):
    return V.confusion(ClusterRun(spark, sf_dir).results)


def q_prf1(spark, sf_dir):
    return _rd(ClusterRun(spark, sf_dir).evaluation)


def q_run_summary(spark, sf_dir):
    run = ClusterRun(spark, sf_dir)
    return _rd(S.run_summary(run.edges, run.scored, run.results, run.evaluation))


def _ranked(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``position``, the row's place in an ordered report, so that the check sees the order. A name with a minus is
    descending."""
    keys = {f"_k{i}": -F.col(o[1:]) if o.startswith("-") else F.col(o) for i, o in enumerate(order)}
    return global_positions(df.withColumns(keys), list(keys), "position").drop(*keys)


def q_score_extract(spark, sf_dir):
    """The cluster-score report through its CSV sink."""
    path = scratch_path(spark, "score-extract")
    write_csv(score_extract(ClusterRun(spark, sf_dir).scored), path)
    kinds = "cluster int, n_nodes long, n_edges long, internal_density double, coeff_variation double, fraud_score double, is_fraud_ring boolean, total_volume double"
    return _rd(_ranked(spark.read.schema(kinds).option("header", "true").csv(path), "-fraud_score", "cluster"))


def q_density_report(spark, sf_dir):
    return _ranked(S.cluster_density_report(ClusterRun(spark, sf_dir).metrics), "-density", "n_nodes", "cluster")


def q_ordered_assignments(spark, sf_dir):
    return _ranked(S.ordered_assignments(ClusterRun(spark, sf_dir).assign), "cluster", "id")


def q_label_breakdown(spark, sf_dir):
    return S.label_breakdown(co_purchase_edges(spark, sf_dir))


def q_degree_top10(spark, sf_dir):
    return S.top_degree_nodes(co_purchase_edges(spark, sf_dir), 10)


def q_graph_density(spark, sf_dir):
    return _rd(S.graph_density(co_purchase_edges(spark, sf_dir)), graph_density=9)


# ---- heat kernel --------------------------------------------------------------------------------------------

def _heat(spark, sf_dir, cfg: HeatConfig | None = None):
    return H.apply_heat_kernel(co_supply_edges(spark, sf_dir), cfg or HeatConfig())


def q_node_risk(spark, sf_dir):
    return _rd(H.node_risk(co_supply_edges(spark, sf_dir)))


def q_suspicious_nodes(spark, sf_dir):
    risk = H.flag_suspicious(H.node_risk(co_supply_edges(spark, sf_dir)), HeatConfig())
    return _rd(risk.select("node_id", "node_risk", "is_faulty_node"))


def q_heat_weights(spark, sf_dir):
    return _rd(_heat(spark, sf_dir)["edges"])


def q_heat_history(spark, sf_dir):
    return _heat(spark, sf_dir)["history"]


def q_heat_frames(spark, sf_dir):
    return _rd(_heat(spark, sf_dir)["frames"])


# ---- clustering ---------------------------------------------------------------------------------------------

def q_power_iteration3(spark, sf_dir):
    return _rd(P.power_iteration(co_supply_edges(spark, sf_dir), PI_STEPS), v=9)


STOP_EPSILON, STOP_MAX = 1e-5, 15


def q_power_iteration_stop(spark, sf_dir):
    """The vector at the step where the power iteration's acceleration falls under the threshold, and that step."""
    edges = materialize(co_supply_edges(spark, sf_dir), "edges")
    end = P.power_iteration_until(edges, STOP_EPSILON, STOP_MAX)
    return _rd(end.vector.select("id", "v", F.lit(end.steps).alias("steps"), F.lit(end.converged).alias("converged")), v=9)


def q_power_iteration_changes(spark, sf_dir):
    """Change and acceleration of every step until then."""
    edges = materialize(co_supply_edges(spark, sf_dir), "edges")
    end = P.power_iteration_until(edges, STOP_EPSILON, STOP_MAX)
    return _rd(spark.createDataFrame(end.history, "step int, change double, acceleration double"), change=12, acceleration=12)


def q_choose_k(spark, sf_dir):
    """The candidates for k rated on the vector after six steps."""
    vector = materialize(P.power_iteration(co_supply_edges(spark, sf_dir), PI_STEPS), "embedding")
    return _rd(O.rate_k(vector)[0].select("k", "score", "chosen"))


MATCH_SPLIT, MATCH_JACCARD = "1998-04-01 00:00:00", 0.1


def q_cluster_matching(spark, sf_dir):
    """Clusters of suppliers by their main customers' nation in two halves of time: kept, born and died."""
    before = materialize(G.main_customer_nations(spark, sf_dir, date_max=MATCH_SPLIT), "assignments")
    after = materialize(G.main_customer_nations(spark, sf_dir, date_min=MATCH_SPLIT), "assignments")
    return _rd(M.match_clusters(before, after, MATCH_JACCARD))


# ---- streams ------------------------------------------------------------------------------------------------

LATENESS = "5 days"
WINDOWS = {"source_col": "payer", "destination_col": "depot", "weight_col": "amount", "label_col": "status", "time_col": "booked", "lateness": LATENESS}


def _deliver(spark, sf_dir, start):
    """The transfers delivered one after the other to a stream, each delivery run to its end by ``start(stream, out, checkpoint)``; returns the
    stream and the output path."""
    feed = materialize(G.delivered_transfers(spark, sf_dir), "feed")
    inbox, out, checkpoint = (scratch_path(spark, name) for name in ("inbox", "windows", "windows-checkpoint"))
    stream = None
    for delivery in range(len(G.DELIVERY_ENDS) + 1):
        feed.filter(F.col("delivery") == delivery).drop("delivery").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(feed.drop("delivery").schema).parquet(inbox)
        start(stream, out, checkpoint).awaitTermination()
    return stream, out


def q_sliding_graph(spark, sf_dir):
    """The edges of all closed 7-day windows, one a day, from a stream with late and repeated deliveries."""

    def start(stream, out, checkpoint):
        return sliding.start_sliding_graph(sliding.sliding_edges(stream, **WINDOWS), out, checkpoint)

    stream, out = _deliver(spark, sf_dir, start)
    return _rd(sliding.read_sliding_graph(spark, sliding.sliding_edges(stream, **WINDOWS), out), volume=4)


WINDOW_K = 3


def _window_clusters(edges):
    vector = materialize(P.power_iteration(edges, PI_STEPS), "window-embedding")
    return {"nodes": vector.join(O.exact_clusters(vector, WINDOW_K), "id")}


def q_reclustered_windows(spark, sf_dir):
    """Embedding and cluster of the nodes of the newest closed window after each delivery, from the published tables."""

    def start(stream, out, checkpoint):
        return recluster.start_reclustering(stream, _window_clusters, out, checkpoint, windows=WINDOWS)

    _, out = _deliver(spark, sf_dir, start)
    return _rd(recluster.read_published(spark, out, "nodes").select("window_end", "node_key", "v", "cluster"), v=9)


# As many clusters as the graph of the clustering queries has parts: the background and the two default rings.
PIC = ClusterConfig(pic_k=3, pic_max_iter=20)


def _ringed_edges(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The co-supply graph with the default rings planted beside it, and its nodes with their part (a ring's label or
    ``background``), both written."""
    edges = co_supply_edges(spark, sf_dir).select("src", "dst", "weight", "true_label")
    rings = R.rings_above(spark, edges, GeneratorConfig().rings)
    edges = materialize(E.with_weight_norm(edges.unionByName(rings)), "edges")
    part = F.when(F.startswith("true_label", F.lit(R.RING_LABEL_PREFIX)), F.col("true_label")).otherwise(F.lit("background")).alias("part")
    nodes = edges.select(F.col("src").alias("id"), part).union(edges.select(F.col("dst").alias("id"), part)).distinct()
    return edges, materialize(nodes, "nodes")


def _clustering_facts(edges: DataFrame, nodes: DataFrame, assignments: DataFrame) -> DataFrame:
    """A row per part of the graph with what holds for every right clustering, whatever clusters k-means picks: each node is assigned
    once, a ring is in one cluster and the graph is not, there are at most k clusters. An edge lies in a cluster of its own nodes or between two."""
    assignments = materialize(assignments, "assignments")
    used = assignments.agg(F.count_distinct("cluster").alias("n"), F.count(F.lit(1)).alias("rows")).select(
        F.col("n").between(2, PIC.pic_k).alias("clusters_within_k"), F.col("rows").alias("n_assigned"))
    parts = nodes.join(assignments, "id", "left").groupBy("part").agg(
        F.count_distinct("id").alias("n_nodes"), F.count_if(F.col("cluster").isNull()).alias("n_without"), F.count_distinct("cluster").alias("n_clusters"))
    cut = C.enrich_edges(edges, assignments).join(nodes.withColumnRenamed("id", "src"), "src").groupBy("part").agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_if(~F.col("same_cluster")).alias("n_cut"))
    ring = F.col("part") != "background"
    return parts.join(cut, "part").select(
        "part", "n_nodes", "n_without", "n_edges", F.when(ring, F.col("n_clusters")).alias("ring_clusters"), F.when(ring, F.col("n_cut")).alias("ring_cut"),
        *[used.select(c).scalar().alias(c) for c in used.columns],
    )


def q_pic_clusters(spark, sf_dir):
    """MLlib PIC on co-supply with planted rings: the facts of its clusters."""
    edges, nodes = _ringed_edges(spark, sf_dir)
    return _clustering_facts(edges, nodes, P.run_pic(edges, PIC))


def q_pic_dataframe(spark, sf_dir):
    """The same from the DataFrame power iteration (20 steps) and MLlib k-means, and how many clusters reach into another's range of the
    embedding: none, as every node is nearest to its own centre."""
    edges, nodes = _ringed_edges(spark, sf_dir)
    P.validate_pic_input(edges)
    vector = materialize(P.power_iteration(edges, PIC.pic_max_iter), "embedding")
    clusters = materialize(P.embedding_clusters(vector, PIC.pic_k), "clusters")
    ranges = vector.join(clusters, "id").groupBy("cluster").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))  # at most k rows
    reaching = ranges.select((F.col("low") <= before).alias("reaches")).agg(F.count_if("reaches"))
    return _clustering_facts(edges, nodes, clusters).withColumn("n_reaching", reaching.scalar())


def q_pic_scores(spark, sf_dir):
    """MLlib PIC on co-supply with planted rings, then metrics, scores and flags (the whole main path): what holds for all of them."""
    from ringlens.plans.runner import analyze_edges

    edges, _ = _ringed_edges(spark, sf_dir)
    out = analyze_edges(edges, PIC)
    cross = C.intra_cross_split(out["enriched"]).select("cross_edges").scalar()
    flagged = (F.col("fraud_score") >= PIC.fraud_score_threshold) & (F.col("n_nodes") <= PIC.micro_cluster_max_size) & (
        F.col("internal_density") >= PIC.min_internal_density)
    return out["scored"].agg(
        F.sum("n_nodes").alias("n_nodes"), F.count(F.lit(1)).between(2, PIC.pic_k).alias("clusters_within_k"),
        (F.sum("n_edges") + cross).alias("n_edges"), F.count_if(flagged != F.col("is_fraud_ring")).alias("wrong_flags"),
        F.count_if(~F.col("fraud_score").between(0, 1)).alias("scores_out_of_range"),
        F.max("volume_per_node_norm").alias("largest_volume_norm"),
    )


def q_planted_graph(spark, sf_dir):
    edges = co_supply_edges(spark, sf_dir)
    rings = R.rings_above(spark, edges, GeneratorConfig().rings)
    return edges.select("src", "dst", "true_label").unionByName(rings.select("src", "dst", "true_label"))


# ---- composite weights, alerts, drift -----------------------------------------------------------------------

COMPOSITE = W.CompositeWeight(window_seconds=30 * 86400, fast_count=8, fast_amount=400_000.0)
ALERT_DAYS = ("1996-02-01", "1998-07-01", "2001-08-01")  # each stands for the month before it; the second day is run twice
ALERT_DENSITY = 0.15


def q_composite_weights(spark, sf_dir):
    t = G.customer_transfers(spark, sf_dir)
    closeness = F.when(F.col("payer_nation") == F.col("payee_nation"), 1.0).when(F.col("payer_region") == F.col("payee_region"), 0.5).otherwise(0.0)
    out = W.composite_weights(t, "payer", "booked", "amount", closeness, COMPOSITE)
    return _rd(out.select("transfer", "line", "payer", "n_recent", "amount_recent", "amount_norm", "time_proximity", "place_closeness", "velocity_flag", "weight"),
               amount_recent=4)


def q_recent_activity(spark, sf_dir):
    out = W.recent_activity(load_table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice", 90 * 86400)
    return _rd(out.withColumn("amount_recent", F.col("amount_recent").cast("double")), amount_recent=4)


def _monthly_density(spark, sf_dir):
    edges = G.monthly_co_supply(spark, sf_dir)
    return A.sliced_density(edges, G.supplier_nation_assignments(spark, sf_dir, edges))


def q_density_drift(spark, sf_dir):
    """Density of every nation's suppliers month by month, and where it left what the first year showed."""
    return _rd(A.drift(_monthly_density(spark, sf_dir), "internal_density", baseline=12, slack=0.02, limit=0.5))


def q_alert_table(spark, sf_dir):
    """Nations whose suppliers were dense in the month before each day, published day by day, one day twice."""
    density = materialize(_monthly_density(spark, sf_dir), "monthly-density")
    path = scratch_path(spark, "alert-table")
    for day in (ALERT_DAYS[0], ALERT_DAYS[1], ALERT_DAYS[1], ALERT_DAYS[2]):
        month = F.add_months(F.lit(day).cast("date"), -1)
        dense = density.filter((F.col("slice") == month) & (F.col("internal_density") >= ALERT_DENSITY))
        A.publish_alerts(dense.select("cluster", "n_nodes", "internal_density"), "cluster", day, path)
    return _rd(A.read_alerts(spark, "cluster", path))


def q_step_sketches(spark, sf_dir):
    """Sketches per month, written, merged for years and for all time, and whether they keep their promised errors against exact counts and ranks.

    Distinct counts are held to four standard errors, ranks to twice the 99 % error.
    """
    edges = materialize(G.customer_transfers(spark, sf_dir).select(
        F.trunc(F.col("booked").cast("date"), "month").alias("month"), "payer", "payee_nation", "amount"), "transfers")
    path = scratch_path(spark, "step-sketches")
    K.step_sketches(edges, "month", "payer", "payee_nation", "amount").write.parquet(path)
    stored = spark.read.parquet(path)
    labels = {"month": F.date_format("step", "yyyy-MM"), "year": F.date_format("step", "yyyy"), "all": F.lit("all")}
    ranges = [K.merge_steps(stored.withColumn("label", c), "label") for c in labels.values()]
    found = K.estimates(ranges[0].union(ranges[1]).union(ranges[2]))
    steps = edges.withColumnRenamed("month", "step")
    label = F.explode(F.array(*labels.values())).alias("label")
    # what is distinct in a month is sent on for the month's ranges, one kind after the other
    payers = steps.select("step", "payer").distinct().select(label, "payer").groupBy("label").agg(F.count_distinct("payer").alias("payers"))
    nations = steps.select("step", "payee_nation").distinct().select(label, "payee_nation").groupBy("label").agg(
        F.count_distinct("payee_nation").alias("nations"))
    rows = steps.select(label, "amount")
    value = F.col("weight_quantiles")
    ranks = rows.join(found.select("label", "weight_quantiles"), "label").groupBy("label").agg(*[
        agg for i in range(len(K.QUANTILES)) for agg in (
            F.avg((F.col("amount") < value[i]).cast("double")).alias(f"below{i}"), F.avg((F.col("amount") <= value[i]).cast("double")).alias(f"upto{i}"))
    ])
    slack = 2 * K.rank_error()
    ranks_kept = [(F.col(f"below{i}") <= q + slack) & (F.col(f"upto{i}") >= q - slack) for i, q in enumerate(K.QUANTILES)]

    def near(estimate, true):
        return F.abs(F.col(estimate) - F.col(true)) <= 4 * K.distinct_error() * F.col(true)

    return found.join(payers, "label").join(nations, "label").join(ranks, "label").select(
        "label", "n_edges", "n_weights", "payers", "nations", near("src_nodes", "payers").alias("payers_kept"),
        near("dst_nodes", "nations").alias("nations_kept"), *[kept.alias(f"quantile{i}_kept") for i, kept in enumerate(ranks_kept)],
    )


# ---- ETL ----------------------------------------------------------------------------------------------------

def raw_transactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edge list (customer -> supplier per line item), classes and features (nation as time step) from the tables."""
    trades = G.trades(spark, sf_dir).select(F.col("src_key").alias("txId1"), F.col("dst_key").alias("txId2"))
    cust = load_table(spark, sf_dir, "customer")
    supp = load_table(spark, sf_dir, "supplier")

    def cls(bal):
        return (
            F.when(F.col(bal) < F.lit(G.ILLICIT_BALANCE_BELOW), F.lit("1"))
            .when(F.col(bal) >= F.lit(G.LICIT_BALANCE_FROM), F.lit("2"))
            .otherwise(F.lit(G.UNKNOWN_CLASS))
        )

    classes = cust.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("txId"), cls("c_acctbal").alias("class")
    ).union(supp.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), cls("s_acctbal")))
    features = cust.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")), F.col("c_nationkey"), F.col("c_acctbal")
    ).union(supp.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.col("s_nationkey"), F.col("s_acctbal")))
    return trades, classes, features


def write_raw_files(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """The raw transactions as CSV files in the shared folder; the features have no header."""
    trades, classes, features = raw_transactions(spark, sf_dir)
    paths = tuple(scratch_path(spark, n) for n in ("edgelist", "classes", "features"))
    trades.write.option("header", "true").csv(paths[0])
    classes.write.option("header", "true").csv(paths[1])
    features.write.option("header", "false").csv(paths[2])
    return paths


def _etl_inputs(spark, sf_dir):
    return X.read_raw_files(spark, *write_raw_files(spark, sf_dir))


def _etl_tables(spark, sf_dir):
    """The inputs of the ETL straight from the tables."""
    edges, classes, features = raw_transactions(spark, sf_dir)
    times = features.toDF("tx_id", "timestamp", "balance").select("tx_id", F.col("timestamp").cast("int"))
    return edges.toDF("src_id", "dst_id"), classes.toDF("tx_id", "class"), times


def q_etl_edges(spark, sf_dir):
    return X.prepare_transaction_edges(*_etl_inputs(spark, sf_dir))


def q_edge_time_modes(spark, sf_dir):
    return X.endpoint_times(*_etl_tables(spark, sf_dir))


def q_edge_label_rule(spark, sf_dir):
    out = X.prepare_transaction_edges(*_etl_tables(spark, sf_dir))
    return out.groupBy("true_label").agg(F.count(F.lit(1)).alias("n_edges"))


def q_etl_stats(spark, sf_dir):
    out = X.prepare_transaction_edges(*_etl_tables(spark, sf_dir))
    path = scratch_path(spark, "etl-out")
    out.write.parquet(path)
    return X.dataset_stats(spark.read.parquet(path), exact=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "edge_prep": q_edge_prep,
    "node_index": q_node_index,
    "time_slice": q_time_slice,
    "weight_repair": q_weight_repair,
    "edge_dedupe": q_edge_dedupe,
    "weight_norm": q_weight_norm,
    "cluster_sizes": q_cluster_sizes,
    "cluster_edge_stats": q_cluster_edge_stats,
    "cluster_metrics": q_cluster_metrics,
    "cluster_scores": q_cluster_scores,
    "intra_cross": q_intra_cross,
    "flagged_volume": q_flagged_volume,
    "node_results": q_node_results,
    "confusion": q_confusion,
    "prf1": q_prf1,
    "run_summary": q_run_summary,
    "score_extract": q_score_extract,
    "density_report": q_density_report,
    "ordered_assignments": q_ordered_assignments,
    "time_slice_text": q_time_slice_text,
    "file_formats": q_file_formats,
    "dirty_edges": q_dirty_edges,
    "label_breakdown": q_label_breakdown,
    "degree_top10": q_degree_top10,
    "graph_density": q_graph_density,
    "node_risk": q_node_risk,
    "suspicious_nodes": q_suspicious_nodes,
    "heat_weights": q_heat_weights,
    "heat_history": q_heat_history,
    "heat_frames": q_heat_frames,
    "power_iteration3": q_power_iteration3,
    "power_iteration_stop": q_power_iteration_stop,
    "power_iteration_changes": q_power_iteration_changes,
    "choose_k": q_choose_k,
    "cluster_matching": q_cluster_matching,
    "sliding_graph": q_sliding_graph,
    "reclustered_windows": q_reclustered_windows,
    "pic_clusters": q_pic_clusters,
    "pic_dataframe": q_pic_dataframe,
    "pic_scores": q_pic_scores,
    "planted_graph": q_planted_graph,
    "recent_activity": q_recent_activity,
    "composite_weights": q_composite_weights,
    "density_drift": q_density_drift,
    "alert_table": q_alert_table,
    "step_sketches": q_step_sketches,
    "etl_edges": q_etl_edges,
    "edge_time_modes": q_edge_time_modes,
    "edge_label_rule": q_edge_label_rule,
    "etl_stats": q_etl_stats,
}
