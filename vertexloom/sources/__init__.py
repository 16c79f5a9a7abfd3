from vertexloom.sources.csv_edges import read_edges_csv, read_edges_dir, read_rows_dir
from vertexloom.sources.csv_vertices import ExportResult, file_size, write_vertices_csv, write_vertices_dir
from vertexloom.sources.graphson import read_graphson, staged_graphson, write_graphson
from vertexloom.sources.schema_file import infer_schema, read_schema, write_schema
from vertexloom.sources.store import (
    GraphCounts,
    copy_graph,
    drop_old_files,
    load_graph,
    read_graph,
    save_graph,
    settled,
    stored_counts,
    write_graph,
    write_split,
)

__all__ = [
    "ExportResult",
    "GraphCounts",
    "copy_graph",
    "drop_old_files",
    "file_size",
    "infer_schema",
    "load_graph",
    "read_edges_csv",
    "read_edges_dir",
    "read_graph",
    "read_graphson",
    "read_rows_dir",
    "read_schema",
    "save_graph",
    "settled",
    "staged_graphson",
    "stored_counts",
    "write_graph",
    "write_graphson",
    "write_schema",
    "write_split",
    "write_vertices_csv",
    "write_vertices_dir",
]
