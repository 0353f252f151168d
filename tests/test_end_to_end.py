"""End-to-end runs: file inputs in three formats, the synthetic default, the heat-kernel path and the CLI."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from ringlens.cli import main as cli_main
from ringlens.config import ClusterConfig, GeneratorConfig, PipelineConfig
from ringlens.plans.runner import run_pipeline
from ringlens.sources import testgraphs as G

from conftest import SF001

SMALL = PipelineConfig(cluster=ClusterConfig(pic_k=4, pic_max_iter=10))


@pytest.fixture(scope="module")
def trade_files(spark):
    base = tempfile.mkdtemp(prefix="ringlens-files-", dir="/tmp")
    t = G.trades(spark, SF001).select(
        F.col("src_key").alias("from"), F.col("dst_key").alias("to"), F.col("amount"),
        F.col("order_date"), F.col("true_label").alias("label"),
    )
    t.write.option("header", "true").option("delimiter", "|").csv(f"{base}/csv")
    t.write.json(f"{base}/json")
    t.write.parquet(f"{base}/parquet")
    return base


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_file_inputs_give_same_summary(spark, trade_files, fmt):
    out = run_pipeline(
        spark, SMALL, input_path=f"{trade_files}/{fmt}", input_format=fmt, source_col="from",
        destination_col="to", weight_col="amount", label_col="label", input_delimiter="|",
    )
    s = out["summary"].first()
    # pair + label is the key: 1,444 customer-supplier pairs carry 3,184 (pair, label) edges at sf0.001
    assert s.total_edges == 3184 and s.n_nodes == 160
    assert s.tp + s.fp + s.fn + s.tn == s.n_nodes


def test_time_slice_and_missing_roles(spark, trade_files):
    out = run_pipeline(
        spark, SMALL, input_path=f"{trade_files}/parquet", source_col="from", destination_col="to",
        weight_col="", label_col="", time_col="order_date", time_min="1997-01-01", time_max="1998-12-31",
    )
    edges = out["edges"]
    assert edges.filter(F.col("weight") != 1.0).count() == 0
    assert {r.true_label for r in edges.select("true_label").distinct().collect()} == {"unknown"}
    with pytest.raises(ValueError):
        run_pipeline(spark, SMALL, input_path=f"{trade_files}/parquet", source_col="nope")


def test_synthetic_default_with_heat_kernel(spark):
    cfg = PipelineConfig(cluster=ClusterConfig(pic_k=15, pic_max_iter=20), use_heat_kernel=True,
                         generator=GeneratorConfig(n_normal_edges=1500))
    out = run_pipeline(spark, cfg)
    s = out["summary"].first()
    assert s.n_nodes > 0 and 0.0 <= s.f1 <= 1.0
    assert out["heat_history"].count() == 6
    meta = out["heat_metadata"].first()
    assert meta.risk_threshold is not None and meta.tau_schedule.startswith("1.2,")


def test_cli_run_and_prepare(spark, trade_files, capsys):
    out_dir = tempfile.mkdtemp(prefix="ringlens-cli-", dir="/tmp")
    rc = cli_main([
        "run", "--input-path", f"{trade_files}/parquet", "--source-col", "from", "--destination-col", "to",
        "--weight-col", "amount", "--label-col", "label", "--pic-k", "3", "--pic-max-iter", "5",
        "--output-dir", out_dir, "--visualize",
    ])
    assert rc == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["total_edges"] == 3184
    assert spark.read.option("header", "true").csv(f"{out_dir}/cluster_scores_csv").count() >= 1


def test_default_run_like_the_reference_smoke_test(spark):
    """Defaults everywhere (synthetic graph, k=200, 40 iterations): the summary has f1 and a positive node count."""
    s = run_pipeline(spark)["summary"].first().asDict()
    assert "f1" in s and "n_nodes" in s and s["n_nodes"] > 0


def test_cli_prepare(spark, capsys):
    import os

    d = tempfile.mkdtemp(prefix="ringlens-cli-prep-", dir="/tmp")
    files = {
        "edges.csv": "txId1,txId2\na,b\nb,c\n",
        "classes.csv": "txId,class\na,1\nb,2\nc,2\n",
        "features.csv": "a,3,x\nb,4,y\nc,9,z\n",
    }
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    rc = cli_main([
        "prepare", "--edges-path", f"{d}/edges.csv", "--classes-path", f"{d}/classes.csv",
        "--features-path", f"{d}/features.csv", "--output-path", f"{d}/out", "--timestamp-mode", "src",
    ])
    assert rc == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["edge_count"] == 2 and stats["min_timestamp"] == 3 and stats["max_timestamp"] == 4
    labels = sorted(r.true_label for r in spark.read.parquet(f"{d}/out").collect())
    assert labels == ["fraud", "normal"]
