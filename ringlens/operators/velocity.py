"""Recent activity of a payer and the composite edge weight that uses it.

A payer's transfers of the last hours are a moving sum. Spark's range frames add up a whole frame again for every row, so a busy payer costs
its rows times the rows of a frame; here every moment enters the sum once, and leaves it once when its window has passed, so the
work is linear. A payer's time is cut into buckets that are summed apart; a moment whose window reaches into the next bucket is
copied there. Transfers of the same second are added up before the shuffle, so a bucket holds at most three rows a second of its
length, whatever share of all rows the payer has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringlens.functions.columns import finite_double, has_key, ratio_or

AMOUNT = "decimal(28,4)"  # sums of decimals are exact and do not depend on the order of the rows


def seconds(df: DataFrame, column: str) -> Column:
    """A date, timestamp or number column as whole seconds; a timestamp without time zone is taken as it is written."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * 86400
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(kind, T.NumericType):
        return F.floor(finite_double(c)).cast("long") if isinstance(kind, (T.DoubleType, T.FloatType)) else c.cast("long")
    raise TypeError(f"{column}: {kind.simpleString()} is no time")


def positive_amount(column: str) -> Column:
    """The amount as a double; null, malformed, not finite and negative amounts are 0."""
    return F.greatest(F.coalesce(finite_double(F.col(f"`{column}`")), F.lit(0.0)), F.lit(0.0))


def recent_activity(
    transfers: DataFrame, payer: str, time: str, amount: str, window_seconds: int, bucket_seconds: int | None = None
) -> DataFrame:
    """``payer, at, n_now, n_recent, amount_recent, gap``: one row per payer and second with a transfer.

    ``n_recent`` and ``amount_recent`` (decimal, amounts rounded to 4 places) cover the payer's transfers from ``window_seconds`` before ``at`` to
    ``at``, both included; ``gap`` is the time since the payer's transfer before, 0 if ``at`` has several, null if there is none in the window. Rows
    without payer or time are left out. ``bucket_seconds`` (at least the window, four windows by default) does not change the result.
    """
    length = 4 * window_seconds if bucket_seconds is None else bucket_seconds
    if not 0 < window_seconds <= length:
        raise ValueError("a bucket is at least as long as the window, and the window longer than 0")
    moments = (
        transfers.select(
            F.col(f"`{payer}`").alias("payer"), seconds(transfers, time).alias("at"), positive_amount(amount).cast(AMOUNT).alias("amount")
        )
        .filter(has_key(F.col("payer").cast("string")) & F.col("at").isNotNull())
        .groupBy("payer", "at").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    )
    at, ends = F.col("at"), F.col("at") + window_seconds
    own, last = at - F.pmod(at, F.lit(length)), ends - F.pmod(ends, F.lit(length))  # buckets by their first second

    def event(bucket: Column, when: Column, leaves: bool, counted: bool) -> Column:
        sign = F.lit(-1 if leaves else 1)
        return F.struct(
            bucket.alias("bucket"), when.alias("at"), F.lit(leaves).alias("leaves"), F.lit(counted).alias("counted"), (sign * F.col("n")).alias("n"),
            (F.when(F.lit(leaves), -F.col("amount")).otherwise(F.col("amount"))).alias("amount"),
        )

    events = moments.select("payer", F.explode(F.array_compact(F.array(
        event(own, at, False, True), event(last, ends, True, False), F.when(own != last, event(last, at, False, False))
    ))).alias("e")).select("payer", "e.*")
    order = Window.partitionBy("payer", "bucket").orderBy("at", "leaves")  # no two events of a bucket are equal in both
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    summed = events.select(
        "payer", "at", "counted", F.col("n").alias("n_now"), F.sum("n").over(upto).alias("n_recent"),
        F.sum("amount").over(upto).cast("decimal(38,4)").alias("amount_recent"),
        (F.col("at") - F.max(F.when(~F.col("leaves"), F.col("at"))).over(before)).alias("gap"),
    ).filter("counted")
    gap = F.when(F.col("n_now") > 1, F.lit(0).cast("long")).when(F.col("gap") <= window_seconds, F.col("gap"))
    return summed.select("payer", "at", "n_now", "n_recent", "amount_recent", gap.alias("gap"))


@dataclass(frozen=True)
class CompositeWeight:
    """Shares of the four terms, and what makes a payer's recent activity count as fast."""

    amount: float = 0.4
    time: float = 0.2
    place: float = 0.2
    velocity: float = 0.2
    window_seconds: int = 86_400
    fast_count: int = 10
    fast_amount: float = float("inf")


def composite_weights(
    transfers: DataFrame, payer: str, time: str, amount: str, closeness: Column, cfg: CompositeWeight | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """``transfers`` with ``n_recent, amount_recent, amount_norm, time_proximity, place_closeness, velocity_flag, weight``, one row per row.

    ``amount_norm`` is the share of the largest amount; ``time_proximity`` falls from 1 to 0 with the time since the payer's transfer before, over
    the window; ``closeness`` is an expression on the transfers (null: 0), cut to 0..1; ``velocity_flag`` is 1 for a payer with
    ``fast_count`` transfers or ``fast_amount`` in the window up to this transfer. A row without payer or time has no recent activity. Columns of
    these names are replaced.
    """
    cfg = cfg or CompositeWeight()
    activity = recent_activity(transfers, payer, time, amount, cfg.window_seconds, bucket_seconds)
    largest = transfers.agg(F.max(positive_amount(amount))).scalar()
    names = ("n_recent", "amount_recent", "amount_norm", "time_proximity", "place_closeness", "velocity_flag", "weight")
    given = transfers.columns
    rows = transfers.select(
        F.struct(*[F.col(f"`{c}`") for c in given]).alias("given"), F.col(f"`{payer}`").alias("payer"), seconds(transfers, time).alias("at"),
        positive_amount(amount).alias("amount"), F.coalesce(closeness.cast("double"), F.lit(0.0)).alias("close"),
    )
    joined = rows.join(activity, ["payer", "at"], "left")
    near = F.when(F.col("gap").isNotNull(), F.lit(1.0) - F.col("gap") / F.lit(float(cfg.window_seconds))).otherwise(F.lit(0.0))
    fast = (F.col("n_recent") >= cfg.fast_count) | (F.col("amount_recent").cast("double") >= F.lit(cfg.fast_amount))
    terms = joined.select(
        "given", F.coalesce("n_recent", F.lit(0)).alias("n_recent"), F.coalesce(F.col("amount_recent").cast("double"), F.lit(0.0)).alias("amount_recent"),
        ratio_or(F.col("amount"), largest, 0.0).alias("amount_norm"), near.alias("time_proximity"),
        F.least(F.greatest(F.col("close"), F.lit(0.0)), F.lit(1.0)).alias("place_closeness"),
        F.when(fast, F.lit(1.0)).otherwise(F.lit(0.0)).alias("velocity_flag"),
    )
    weight = (
        F.lit(cfg.amount) * F.col("amount_norm") + F.lit(cfg.time) * F.col("time_proximity")
        + F.lit(cfg.place) * F.col("place_closeness") + F.lit(cfg.velocity) * F.col("velocity_flag")
    )
    kept = [c for c in given if c.lower() not in names]
    return terms.withColumn("weight", weight).select(*[F.col(f"given.`{c}`").alias(c) for c in kept], *names)
