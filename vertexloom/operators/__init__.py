from vertexloom.operators.adjacency import neighbours, stars
from vertexloom.operators.construct import (
    add_edges,
    add_vertices,
    both_directions,
    clear_edges,
    clear_vertices,
    endpoints,
    graph_from_edges,
    merge_vertices,
    project_edges,
    split_graph,
    with_property,
)
from vertexloom.operators.pagerank import PageRankResult, pagerank
from vertexloom.operators.peer_pressure import PeerPressureResult, peer_pressure
from vertexloom.operators.select import (
    graph_counts,
    has,
    has_label,
    num_clusters,
    num_edges,
    num_vertices,
    out_degrees,
    top_vertices,
    value_map,
    vertex_ids,
    vertex_table,
)

__all__ = [
    "PageRankResult",
    "PeerPressureResult",
    "add_edges",
    "add_vertices",
    "both_directions",
    "clear_edges",
    "clear_vertices",
    "endpoints",
    "graph_counts",
    "graph_from_edges",
    "has",
    "has_label",
    "merge_vertices",
    "neighbours",
    "num_clusters",
    "num_edges",
    "num_vertices",
    "out_degrees",
    "pagerank",
    "peer_pressure",
    "project_edges",
    "split_graph",
    "stars",
    "top_vertices",
    "value_map",
    "vertex_ids",
    "vertex_table",
    "with_property",
]
