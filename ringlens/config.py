"""Frozen configuration objects.

Fixed values: the defaults below must equal the reference defaults for equal results.
  clustering: k = 200, max iterations = 40, init mode = "random"
  flagging:   score threshold = 0.35, max cluster size = 2000, min internal density = 0.01
  score:      density weight = 0.50, uniformity weight = 0.30, volume weight = 0.20
  heat:       tau 1.2 -> 0.2 over 6 steps, distance scale = 1.0, faulty quantile = 0.95,
              faulty edge boost = 0.35, frame edges = 700, frame min weight = 0.08,
              hot-area threshold = 0.7
  rings:      8 nodes, weight 950 +- 15, ids from 10000; 6 nodes, weight 480 +- 8, ids from 20000
  background: 500 nodes, 3000 drawn edges, lognormal(4.5, 1.2) weights floored at 1.0, seed 42
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RingSpec:
    n_nodes: int
    weight_mean: float
    weight_std: float
    id_offset: int


def _default_rings() -> tuple[RingSpec, ...]:
    return (
        RingSpec(n_nodes=8, weight_mean=950.0, weight_std=15.0, id_offset=10_000),
        RingSpec(n_nodes=6, weight_mean=480.0, weight_std=8.0, id_offset=20_000),
    )


@dataclass(frozen=True)
class ClusterConfig:
    pic_k: int = 200
    pic_max_iter: int = 40
    pic_init_mode: str = "random"
    # Edge partitions of MLlib's clustering. Its random start is drawn per partition, so this number is part of the result.
    # It is never derived from the input or the cluster. MLlib gets graphs of up to operators.pic.MLLIB_EDGES edges a partition.
    pic_partitions: int = 16
    fraud_score_threshold: float = 0.35
    micro_cluster_max_size: int = 2000
    min_internal_density: float = 0.01
    density_weight: float = 0.50
    uniformity_weight: float = 0.30
    volume_weight: float = 0.20
    # 1 keeps every cluster eligible (reference behaviour); 2 stops one-edge pairs being flagged (T4).
    min_cluster_size: int = 1


@dataclass(frozen=True)
class HeatConfig:
    tau_start: float = 1.2
    tau_end: float = 0.2
    steps: int = 6
    distance_scale: float = 1.0
    faulty_quantile: float = 0.95
    faulty_edge_boost: float = 0.35
    frame_max_edges: int = 700
    frame_min_weight: float = 0.08
    hot_threshold: float = 0.7
    # True: exact discrete quantile (rank ceil(q*n)); False: Spark's approximate quantile (relative error 0.01).
    exact_quantile: bool = True


@dataclass(frozen=True)
class GeneratorConfig:
    n_normal_nodes: int = 500
    n_normal_edges: int = 3000
    seed: int = 42
    background_log_mean: float = 4.5
    background_log_sigma: float = 1.2
    rings: tuple[RingSpec, ...] = field(default_factory=_default_rings)


@dataclass(frozen=True)
class PipelineConfig:
    cluster: ClusterConfig = field(default_factory=ClusterConfig)
    heat: HeatConfig = field(default_factory=HeatConfig)
    generator: GeneratorConfig = field(default_factory=GeneratorConfig)
    use_heat_kernel: bool = False
    # True: one edge per node pair (max weight, most suspicious label). False: the pair and label form the key (T1).
    one_edge_per_pair: bool = False
    # True: only nodes with a known label are counted in the evaluation.
    labelled_only: bool = False
