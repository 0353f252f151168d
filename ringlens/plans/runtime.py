"""Session-level helpers: where to put materialised tables, and how to cut lineage.

The library never builds or stops a session and never sets the master. Lineage is cut by writing a
Parquet table under the shared folder the cluster names in ``spark.checkpoint.dir``; that survives the
loss of any executor, unlike a cache or a local checkpoint.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[int, str] = {}
_WRITTEN: dict[int, list[str]] = {}

# Session settings for large inputs (pass to spark-submit; the library never sets them itself).
# Partitions target ~256 MB after AQE coalescing; a skewed partition (5x the median and > 256 MB) is split;
# scans read 512 MB per task so 100 TB is ~200k tasks instead of 800k; Kryo serves the RDD-based MLlib PIC.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session (``spark.checkpoint.dir`` or ``SparkContext.getCheckpointDir``). Only a local-mode
    session without one (tests) gets a private folder; a cluster session without one is an error.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if not found:
        found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if found:
            sc.setCheckpointDir(found)
            found = sc.getCheckpointDir() or found
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    key = id(sc)
    if key not in _LOCAL_DIRS:
        _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="ringlens-ckpt-", dir="/tmp")
        sc.setCheckpointDir(_LOCAL_DIRS[key])
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, which :func:`release_scratch` deletes."""
    path = f"{shared_dir(spark)}/ringlens/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(id(spark.sparkContext), []).append(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    One job computes the plan (no double evaluation as with an un-persisted RDD checkpoint); later
    readers get a short lineage, column pruning and filter pushdown on the written files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the tables this session materialised (call when their readers are done); returns how many."""
    paths = _WRITTEN.pop(id(spark.sparkContext), [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return len(paths)
