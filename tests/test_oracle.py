"""Every registered query with a SQL twin equals DuckDB on the sf0.01 tables (rows, columns, values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as ent  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from conftest import SF01  # noqa: E402

SQL = ent.oracle_sql()
QUERIES = ent.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    info = compare(spark, con, name, QUERIES[name], SQL[name], SF01)
    assert info["cols_ok"], info
    assert info["rows"] == info["oracle_rows"], info
    assert info["ok"], info


@pytest.mark.parametrize("name", ["cluster_metrics", "heat_history", "node_index"])
def test_same_result_on_other_partitionings(spark, con, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert compare(spark, con, name, QUERIES[name], SQL[name], SF01)["ok"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
