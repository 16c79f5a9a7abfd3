from vertexloom.plans.jobs import (
    RankAndCluster,
    cluster_files,
    label_propagation,
    load_edges,
    maintain,
    rank_and_cluster,
)

__all__ = ["RankAndCluster", "cluster_files", "label_propagation", "load_edges", "maintain", "rank_and_cluster"]
