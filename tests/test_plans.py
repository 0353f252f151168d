"""Executed plans of registered queries: no cartesian or nested-loop joins and no Python evaluation."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as ent  # noqa: E402
from plan_report import summarise  # noqa: E402

from conftest import SF001  # noqa: E402


@pytest.mark.parametrize("name", ["edge_prep", "cluster_scores", "run_summary", "heat_history", "power_iteration3"])
def test_plan_stays_in_jvm_without_cartesian(spark, name):
    c = summarise(ent.queries()[name](spark, SF001))
    assert c["bnlj"] == 0 and c["python"] == 0, c
    assert c["codegen"] >= 1, c
