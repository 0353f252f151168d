from ringlens.functions.columns import (
    clean_key,
    edge_label_from_classes,
    endpoint_time,
    finite_double,
    repaired_weight,
    round_doubles,
)

__all__ = [
    "clean_key",
    "edge_label_from_classes",
    "endpoint_time",
    "finite_double",
    "repaired_weight",
    "round_doubles",
]
