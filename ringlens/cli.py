"""Command line: ``python -m ringlens.cli run ...`` (the pipeline) and ``python -m ringlens.cli prepare ...`` (raw
transaction files -> edge table).

Submit with ``spark-submit`` (or plain ``python`` for a local session): the master, memory and cluster settings
come from the submitter, not from this program. Result tables are written under ``--output-dir``; the one-row
summary is printed as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ringlens.config import ClusterConfig, HeatConfig, PipelineConfig


# Flag -> configuration class, its field, and the range the value is kept in. Types and defaults are the field's.
CONFIG_FLAGS = {
    "--pic-k": (ClusterConfig, "pic_k", None),
    "--pic-max-iter": (ClusterConfig, "pic_max_iter", None),
    "--pic-partitions": (ClusterConfig, "pic_partitions", (1, None)),
    "--fraud-score-threshold": (ClusterConfig, "fraud_score_threshold", None),
    "--micro-cluster-max-size": (ClusterConfig, "micro_cluster_max_size", None),
    "--min-cluster-size": (ClusterConfig, "min_cluster_size", None),
    "--min-internal-density": (ClusterConfig, "min_internal_density", (0.0, None)),
    "--tau-start": (HeatConfig, "tau_start", None),
    "--tau-end": (HeatConfig, "tau_end", None),
    "--cooling-steps": (HeatConfig, "steps", (1, None)),
    "--faulty-node-quantile": (HeatConfig, "faulty_quantile", (0.0, 1.0)),
    "--faulty-edge-boost": (HeatConfig, "faulty_edge_boost", (0.0, None)),
}


def _configured(config, args):
    """A configuration with the values of its flags."""
    values = {}
    for owner, name, limits in CONFIG_FLAGS.values():
        if owner is config:
            low, high = limits or (None, None)
            value = getattr(args, name)
            value = value if low is None else max(value, low)
            values[name] = value if high is None else min(value, high)
    return config(**values)


def _run_parser(sub) -> None:
    p = sub.add_parser("run", help="run the pipeline")
    p.add_argument("--output-dir", default="outputs")
    p.add_argument("--visualize", action="store_true", help="also write the score extract and heat history as CSV")
    p.add_argument("--input-path", default=None)
    p.add_argument("--input-format", default="parquet")
    p.add_argument("--source-col", default="src")
    p.add_argument("--destination-col", default="dst")
    p.add_argument("--weight-col", default="weight", help="empty string: every edge weighs 1.0")
    p.add_argument("--label-col", default="true_label", help="empty string: every label is 'unknown'")
    p.add_argument("--time-col", default="")
    p.add_argument("--time-min", default=None)
    p.add_argument("--time-max", default=None)
    p.add_argument("--input-has-header", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--input-delimiter", default=",")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--clusterer", default="mllib", choices=["mllib", "dataframe"])
    p.add_argument("--heat-kernel", action="store_true")
    p.add_argument("--one-edge-per-pair", action="store_true", help="one edge per node pair whatever its labels")
    p.add_argument("--labelled-only", action="store_true", help="evaluate only nodes with a known label")
    for flag, (config, name, _) in CONFIG_FLAGS.items():
        default = getattr(config(), name)
        p.add_argument(flag, dest=name, type=type(default), default=default)


def _prepare_parser(sub) -> None:
    p = sub.add_parser("prepare", help="raw transaction CSVs -> Parquet edge table")
    p.add_argument("--edges-path", required=True)
    p.add_argument("--classes-path", required=True)
    p.add_argument("--features-path", required=True)
    p.add_argument("--output-path", required=True)
    p.add_argument("--timestamp-mode", choices=["src", "dst", "max", "min"], default="max")
    p.add_argument("--default-amount", type=float, default=1.0)


def _number(value):
    if value is None:
        return None
    try:
        return float(value)
    except ValueError:
        return value  # a date or timestamp text


def run(args, spark: SparkSession) -> dict:
    from ringlens.plans.runner import run_pipeline
    from ringlens.plans.runtime import release_scratch
    from ringlens.sources.sinks import score_extract, write_csv, write_parquet

    cfg = PipelineConfig(
        cluster=_configured(ClusterConfig, args), heat=_configured(HeatConfig, args), use_heat_kernel=args.heat_kernel,
        one_edge_per_pair=args.one_edge_per_pair, labelled_only=args.labelled_only,
    )
    out = run_pipeline(
        spark,
        cfg,
        input_path=args.input_path,
        input_format=args.input_format,
        source_col=args.source_col,
        destination_col=args.destination_col,
        weight_col=args.weight_col or None,
        label_col=args.label_col or None,
        time_col=args.time_col or None,
        time_min=_number(args.time_min),
        time_max=_number(args.time_max),
        input_has_header=args.input_has_header,
        input_delimiter=args.input_delimiter,
        clusterer=args.clusterer,
    )
    base = args.output_dir.rstrip("/")
    for name in ("scored", "node_results", "assignments", "evaluation", "summary"):
        write_parquet(out[name], f"{base}/{name}")
    for name in ("heat_history", "heat_frames", "node_risk", "heat_metadata"):
        if name in out:
            write_parquet(out[name], f"{base}/{name}")
    if args.visualize:
        write_csv(score_extract(out["scored"]), f"{base}/cluster_scores_csv")
        if "heat_history" in out:
            write_csv(out["heat_history"], f"{base}/heat_history_csv")
    row = spark.read.parquet(f"{base}/summary").first()
    release_scratch(spark)  # all results are written; the intermediate tables are not read any more
    return row.asDict() if row else {}


def prepare(args, spark: SparkSession) -> dict:
    from ringlens.operators.etl import run_etl

    stats = run_etl(
        spark, args.edges_path, args.classes_path, args.features_path, args.output_path,
        args.timestamp_mode, args.default_amount,
    ).first()
    return stats.asDict() if stats else {}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ringlens")
    sub = parser.add_subparsers(dest="command", required=True)
    _run_parser(sub)
    _prepare_parser(sub)
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(f"ringlens-{args.command}")
    if getattr(args, "shuffle_partitions", None):
        builder = builder.config("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    spark = builder.getOrCreate()
    result = run(args, spark) if args.command == "run" else prepare(args, spark)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
