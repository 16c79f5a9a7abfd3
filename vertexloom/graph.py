"""The property graph: a vertex table and an edge table on one Spark session."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

# Labels of graphs without a name, suffixes of named graphs.
VERTEX_LABEL = "SimpleV"
EDGE_LABEL = "SimpleE"
VERTEX_SUFFIX = "-V"
EDGE_SUFFIX = "-E"

VERTEX_COLUMNS = ("id", "label")
EDGE_COLUMNS = ("edge_id", "src", "dst", "label")

# An edge property named like one of EDGE_COLUMNS lives in a column with this suffix; in
# graphs read from adjacency JSON also a vertex property named like one of VERTEX_COLUMNS,
# and a property whose name differs from another's only in case.
PROPERTY_SUFFIX = "__prop"


@dataclass(frozen=True)
class Graph:
    """A directed multigraph.

    ``vertices`` has one row per vertex: ``id STRING, label STRING`` and the
    vertex properties. ``edges`` has one row per edge: ``src STRING, dst STRING,
    label STRING`` and the edge properties; parallel edges are separate rows.
    Every endpoint is expected to be a vertex.
    """

    vertices: DataFrame
    edges: DataFrame
    name: str | None = None

    @property
    def spark(self) -> SparkSession:
        return self.vertices.sparkSession

    @property
    def vertex_properties(self) -> list[str]:
        return [c for c in self.vertices.columns if c not in VERTEX_COLUMNS]

    @property
    def edge_properties(self) -> list[str]:
        return [c for c in self.edges.columns if c not in EDGE_COLUMNS]

    def with_vertices(self, vertices: DataFrame) -> Graph:
        return replace(self, vertices=vertices)

    def with_edges(self, edges: DataFrame) -> Graph:
        return replace(self, edges=edges)


def labels_of(name: str | None) -> tuple[str, str]:
    """Vertex and edge label of a graph with this name."""
    if name is None:
        return VERTEX_LABEL, EDGE_LABEL
    return name + VERTEX_SUFFIX, name + EDGE_SUFFIX


def property_column(name: str) -> str:
    """Column that holds the edge property ``name``."""
    return name + PROPERTY_SUFFIX if name.lower() in EDGE_COLUMNS else name


def property_name(column: str) -> str:
    """Inverse of :func:`property_column`."""
    return column.removesuffix(PROPERTY_SUFFIX)


def property_columns(names: Iterable[str], fixed: Sequence[str]) -> dict[str, str]:
    """A column for each property name; one named like a ``fixed`` or an earlier one, in any case, gets suffixes."""
    taken, columns = set(fixed), {}
    for name in names:
        column = name
        while column.lower() in taken:
            column += PROPERTY_SUFFIX
        taken.add(column.lower())
        columns[name] = column
    return columns


def property_names(columns: Sequence[str], fixed: Sequence[str]) -> dict[str, str]:
    """Inverse of :func:`property_columns`, by column."""
    taken, found = {*fixed, *(c.lower() for c in columns)}, {}
    for column in columns:
        name = column
        while name.endswith(PROPERTY_SUFFIX) and name.removesuffix(PROPERTY_SUFFIX).lower() in taken:
            name = name.removesuffix(PROPERTY_SUFFIX)
        found[column] = column if name != column and name in columns else name
    return found
