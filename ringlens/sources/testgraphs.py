"""Edge tables derived from the driver's TPC-H-like tables.

* ``trades``: one row per line item: customer -> supplier, amount, order date, label from the return flag.
  Bipartite (customers only meet suppliers), so it serves edge preparation, labels, time slices,
  node risk and evaluation, not clustering.
* ``co_supply`` / ``co_purchase``: suppliers (parts) that appear in the same order. Instead of every pair
  inside an order (quadratic in a hot order), each line links its supplier (part) to the order's anchor,
  the smallest supplier (part) key of the order: one edge per line item, a star per order. The anchor
  comes from a partial+final aggregate and is joined back on the order key (AQE splits a hot order).

Labels of supplier edges follow the endpoint-class rule with supplier classes from the account balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlens.functions.columns import (
    FRAUD_LABEL,
    ILLICIT_CLASS,
    LICIT_CLASS,
    NORMAL_LABEL,
    UNKNOWN_LABEL,
    edge_label_from_classes,
)
from ringlens.sources.tables import load_table

# Fixed values of the test graphs (our own choice, mirrored in the oracle SQL).
RETURN_FLAG_LABELS = {"R": FRAUD_LABEL, "A": NORMAL_LABEL}  # any other flag: unknown
ILLICIT_BALANCE_BELOW = 1000.0  # supplier class "1" below this balance
LICIT_BALANCE_FROM = 2000.0  # class "2" from this balance; in between: class "3" (unknown)
UNKNOWN_CLASS = "3"


def return_flag_label(col: str = "l_returnflag"):
    c = F.col(col)
    return (
        F.when(c == F.lit("R"), F.lit(RETURN_FLAG_LABELS["R"]))
        .when(c == F.lit("A"), F.lit(RETURN_FLAG_LABELS["A"]))
        .otherwise(F.lit(UNKNOWN_LABEL))
    )


def supplier_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_id long, class string`` for suppliers: "1" illicit, "2" licit, "3" unknown."""
    s = load_table(spark, sf_dir, "supplier")
    bal = F.col("s_acctbal")
    cls = (
        F.when(bal < F.lit(ILLICIT_BALANCE_BELOW), F.lit(ILLICIT_CLASS))
        .when(bal >= F.lit(LICIT_BALANCE_FROM), F.lit(LICIT_CLASS))
        .otherwise(F.lit(UNKNOWN_CLASS))
    )
    return s.select(F.col("s_suppkey").alias("tx_id"), cls.alias("class"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src_key, dst_key string, amount double, order_date timestamp_ntz, true_label string``."""
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("src_key"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst_key"),
        F.col("l_extendedprice").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
        return_flag_label().alias("true_label"),
    )


def _order_star(spark: SparkSession, sf_dir: str, member: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", member, "l_extendedprice", "l_returnflag")
    anchor = li.groupBy("l_orderkey").agg(F.min(member).alias("anchor"))
    return li.join(anchor, "l_orderkey", "inner")


def co_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw supplier edges ``src, dst long, weight double, true_label string`` (one per line item)."""
    star = _order_star(spark, sf_dir, "l_suppkey")
    cls = supplier_classes(spark, sf_dir)
    src_cls = cls.select(F.col("tx_id").alias("anchor"), F.col("class").alias("src_class"))
    dst_cls = cls.select(F.col("tx_id").alias("l_suppkey"), F.col("class").alias("dst_class"))
    return (
        star.join(src_cls, "anchor", "left")
        .join(dst_cls, "l_suppkey", "left")
        .select(
            F.col("anchor").alias("src"),
            F.col("l_suppkey").alias("dst"),
            F.col("l_extendedprice").alias("weight"),
            edge_label_from_classes("src_class", "dst_class").alias("true_label"),
        )
    )


def co_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw part edges ``src, dst long, weight double, true_label string``; label from the line's return flag,
    so a pair can carry two labels (parallel edges)."""
    star = _order_star(spark, sf_dir, "l_partkey")
    return star.select(
        F.col("anchor").alias("src"),
        F.col("l_partkey").alias("dst"),
        F.col("l_extendedprice").alias("weight"),
        return_flag_label().alias("true_label"),
    )


def supplier_nation_assignments(spark: SparkSession, sf_dir: str, edges: DataFrame) -> DataFrame:
    """A given clustering for oracle tests: every supplier node of ``edges`` in the cluster of its nation
    (``id, cluster``), so no clustering output enters the check of the cluster operators."""
    nodes = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id")))
    return (
        load_table(spark, sf_dir, "supplier")
        .select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("int").alias("cluster"))
        .join(nodes, "id", "left_semi")
    )


# Fixed values of the deliveries (our own choice, mirrored in the oracle SQL): a transfer arrives up to 10 days after it was booked, every 50th
# 500 days after it; every 13th is delivered again two days later. A delivery holds what arrived before its date.
DELIVERY_ENDS = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2000-06-01 00:00:00")


def delivered_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers from customers to depots, one per order, as a feed delivers them: ``payer, depot, amount, booked, status, delivery``."""
    o = load_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    delay = F.pmod(key * F.lit(7), F.lit(11)) + F.when(F.pmod(key, F.lit(50)) == 3, 500).otherwise(0)
    again = F.when(F.pmod(key, F.lit(13)) == 0, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    sent = o.select("*", delay.alias("delay"), F.explode(again).alias("later"))
    booked = F.col("o_orderdate").cast("timestamp_ntz")
    arrived = F.date_add(booked.cast("date"), (F.col("delay") + F.col("later")).cast("int")).cast("timestamp_ntz")
    delivery = sum((F.when(arrived >= F.lit(end).cast("timestamp_ntz"), 1).otherwise(0) for end in DELIVERY_ENDS), F.lit(0))
    return sent.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("payer"),
        F.concat(F.lit("D"), F.pmod("o_orderkey", F.lit(97)).cast("string")).alias("depot"),
        F.col("o_totalprice").alias("amount"), booked.alias("booked"), F.col("o_orderstatus").alias("status"), delivery.cast("int").alias("delivery"),
    )


def main_customer_nations(spark: SparkSession, sf_dir: str, date_min: str | None = None, date_max: str | None = None) -> DataFrame:
    """A given clustering of suppliers (``id, cluster``): the nation of most of a supplier's customers by line items of orders from
    ``date_min`` to before ``date_max``, the smaller key of equal ones."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("day"))
    if date_min is not None:
        o = o.filter(F.col("day") >= F.lit(date_min).cast("timestamp_ntz"))
    if date_max is not None:
        o = o.filter(F.col("day") < F.lit(date_max).cast("timestamp_ntz"))
    c = load_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    li = load_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("id"))
    lines = li.join(o, "o_orderkey").join(c, "o_custkey").groupBy("id", "nation").agg(F.count(F.lit(1)).alias("n"))
    return lines.groupBy("id").agg(F.min(F.struct(-F.col("n"), F.col("nation").alias("nation"))).alias("best")).select(
        "id", F.col("best.nation").cast("int").alias("cluster")
    )


def customer_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transfers with the places of both ends: ``transfer, line, payer, amount, booked, payer_nation, payee_nation, payer_region, payee_region``."""
    place = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    c = load_table(spark, sf_dir, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_nationkey").alias("payer_nation"), F.col("n_regionkey").alias("payer_region"))
    s = load_table(spark, sf_dir, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_nationkey").alias("payee_nation"), F.col("n_regionkey").alias("payee_region"))
    o = load_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    # orders meet their customers first: they are fewer than their lines
    return li.join(o.join(c, "o_custkey"), "l_orderkey").join(s, "l_suppkey").select(
        F.col("l_orderkey").alias("transfer"), F.col("l_linenumber").alias("line"), F.col("o_custkey").alias("payer"),
        F.col("l_extendedprice").alias("amount"), F.col("o_orderdate").alias("booked"), "payer_nation", "payee_nation", "payer_region", "payee_region",
    )


def monthly_co_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw supplier edges by month of the order: ``slice date, src, dst``."""
    month = load_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("slice"))
    return _order_star(spark, sf_dir, "l_suppkey").join(month, "l_orderkey").select(
        "slice", F.col("anchor").alias("src"), F.col("l_suppkey").alias("dst"))
