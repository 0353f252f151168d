"""ringlens: suspicious-group analytics on transaction graphs, written as Spark DataFrame operators.

Every public operator takes DataFrames (plus a frozen config) and returns a DataFrame. No operator creates or
stops a session, sets the master, or collects a table to the driver.
"""

import importlib

_HOMES = {"analyze_edges": "ringlens.plans.runner", "run_pipeline": "ringlens.plans.runner"}

__all__ = [
    "ClusterConfig",
    "GeneratorConfig",
    "HeatConfig",
    "PipelineConfig",
    "RingSpec",
    "analyze_edges",
    "run_pipeline",
]


def __getattr__(name: str):
    """Public names are loaded on first use, so that a Python worker that needs one module does not import all."""
    if name in __all__:
        return getattr(importlib.import_module(_HOMES.get(name, "ringlens.config")), name)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
