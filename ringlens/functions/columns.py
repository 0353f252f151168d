"""Column expressions shared by the operators. All are built-in Spark expressions (code-generated, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Label vocabulary of the edge tables.
NORMAL_LABEL = "normal"
UNKNOWN_LABEL = "unknown"
FRAUD_LABEL = "fraud"
# Endpoint classes of the raw transaction files ("1" illicit, "2" licit, anything else unknown).
ILLICIT_CLASS = "1"
LICIT_CLASS = "2"

TIME_MODES = ("src", "dst", "min", "max")


def clean_key(col: Column | str) -> Column:
    """Node key as a trimmed string (ids like ``007`` keep their zeros because the input is read as text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c.cast(T.StringType()))


def has_key(col: Column | str) -> Column:
    """Whether a cleaned key names a node: neither null nor blank (a null length is not positive)."""
    return F.coalesce(F.length(col), F.lit(0)) > 0


def ratio_or(top: Column | str, bottom: Column | str, default: float) -> Column:
    """``top / bottom`` where ``bottom`` is positive, else ``default``."""
    t, b = (F.col(c) if isinstance(c, str) else c for c in (top, bottom))
    return F.when(b > 0, t / b).otherwise(F.lit(default))


def finite_double(col: Column | str) -> Column:
    """``try_cast`` to double; malformed text, NaN and +-Infinity become null."""
    c = (F.col(col) if isinstance(col, str) else col).try_cast(T.DoubleType())
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast(T.DoubleType())).otherwise(c)


def repaired_weight(col: Column | str) -> Column:
    """Weight repair: null, malformed, NaN, infinite or <= 0 becomes 1.0."""
    c = finite_double(col)
    return F.when(c.isNull() | (c <= F.lit(0.0)), F.lit(1.0)).otherwise(c)


def endpoint_time(src_time: Column | str, dst_time: Column | str, mode: str = "max") -> Column:
    """Edge time from the two endpoint times. ``min``/``max`` skip a null side."""
    s = F.col(src_time) if isinstance(src_time, str) else src_time
    d = F.col(dst_time) if isinstance(dst_time, str) else dst_time
    if mode == "src":
        return s
    if mode == "dst":
        return d
    if mode == "min":
        return F.least(s, d)
    if mode == "max":
        return F.greatest(s, d)
    raise ValueError(f"time mode must be one of {TIME_MODES}, got {mode!r}")


def edge_label_from_classes(src_class: Column | str, dst_class: Column | str) -> Column:
    """Either endpoint illicit -> fraud; both licit -> normal; otherwise unknown."""
    s = F.col(src_class) if isinstance(src_class, str) else src_class
    d = F.col(dst_class) if isinstance(dst_class, str) else dst_class
    return (
        F.when((s == F.lit(ILLICIT_CLASS)) | (d == F.lit(ILLICIT_CLASS)), F.lit(FRAUD_LABEL))
        .when((s == F.lit(LICIT_CLASS)) & (d == F.lit(LICIT_CLASS)), F.lit(NORMAL_LABEL))
        .otherwise(F.lit(UNKNOWN_LABEL))
    )


def is_fraud_label(col: Column | str) -> Column:
    """Labels other than normal/unknown name a fraud group; null is not one."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & ~c.isin(NORMAL_LABEL, UNKNOWN_LABEL)


def round_doubles(df: DataFrame, places: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (for comparing engines whose sums run in another order)."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), overrides.get(f.name, places)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
