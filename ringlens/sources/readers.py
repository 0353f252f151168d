"""Edge-file scans: CSV, JSON, Parquet or any other Spark format; and the raw-file readers of the ETL.

CSV is read as text (no schema inference), so keys like ``007`` keep their zeros; weight and time
columns are converted later with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringlens.functions.columns import clean_key


def read_edge_file(
    spark: SparkSession,
    path: str,
    input_format: str = "parquet",
    has_header: bool = True,
    delimiter: str = ",",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Scan an edge file; ``input_format`` is ``csv``, ``json``, ``parquet`` or any Spark source name."""
    fmt = input_format.lower()
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return (
            reader.option("header", str(bool(has_header)).lower())
            .option("inferSchema", "false")
            .option("delimiter", delimiter)
            .csv(path)
        )
    if fmt == "json":
        return reader.json(path)
    return reader.format(fmt).load(path)


def read_headed_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Headed CSV as text; ``columns`` maps file column -> output name; values trimmed strings."""
    df = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required column: {missing[0]}")
    return df.select(*[clean_key(src).alias(dst) for src, dst in columns.items()])


def read_positional_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV: ``_c0`` is the id (trimmed text), ``_c1`` an integer time step; other columns ignored.

    Only the two needed columns are selected, so the CSV scan prunes the rest.
    """
    df = spark.read.option("header", "false").option("inferSchema", "false").csv(path)
    return df.select(clean_key("_c0").alias("tx_id"), F.col("_c1").try_cast(T.IntegerType()).alias("timestamp"))


EDGE_ROW_SCHEMA = "src long, dst long, weight double, true_label string"


def edge_rows(spark: SparkSession, rows) -> DataFrame:
    """Small in-memory edge lists (tests, examples) with the fixed typed schema
    ``src long, dst long, weight double, true_label string``; feed the result to ``prepare_typed_edges``."""
    return spark.createDataFrame(list(rows), EDGE_ROW_SCHEMA)
