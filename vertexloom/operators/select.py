"""Filters, projections, counts and top-k on graphs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexloom.graph import Graph


def has_label(rows: DataFrame, label: str) -> DataFrame:
    """Vertices or edges with this label."""
    return rows.where(F.col("label") == label)


def has(rows: DataFrame, column: str, value=None, within: Iterable | None = None) -> DataFrame:
    """Rows whose property equals ``value``, or is one of ``within``."""
    property_ = F.col(f"`{column}`")
    return rows.where(property_.isin(list(within)) if within is not None else property_ == F.lit(value))


def vertex_ids(graph: Graph) -> DataFrame:
    return graph.vertices.select("id")


def vertex_table(graph: Graph, properties: Sequence[str]) -> DataFrame:
    """Named vertex properties as columns, ``name`` first unless it is placed.

    ``name`` is the vertex id unless a vertex has a property of that name.
    """
    wanted = list(properties) if "name" in properties else ["name", *properties]
    vertices = graph.vertices
    columns = []
    for p in wanted:
        known = p in vertices.columns
        if p != "name" and not known:
            raise ValueError(f"no vertex property {p}")
        value = vertices[f"`{p}`"] if known else vertices["id"]
        columns.append((F.coalesce(value, vertices["id"]) if p == "name" else value).alias(p))
    return vertices.select(columns)


def value_map(
    graph: Graph,
    properties: Sequence[str] | None = None,
    with_id_label: bool = False,
    as_map: bool = False,
) -> DataFrame:
    """Vertex properties: all or the named ones, as columns or as one text map.

    The map leaves out properties that a vertex does not have.
    """
    wanted = list(graph.vertex_properties if properties is None else properties)
    table = graph.vertices.select(
        "id", *(["label"] if with_id_label else []), *[F.col(f"`{p}`") for p in wanted]
    )
    if not as_map:
        return table
    entries = F.map_from_arrays(
        F.array(*[F.lit(p) for p in wanted]), F.array(*[F.col(f"`{p}`").cast("string") for p in wanted])
    )
    present = F.map_filter(entries, lambda _, value: value.isNotNull())
    return table.select("id", *(["label"] if with_id_label else []), present.alias("properties"))


def num_vertices(graph: Graph) -> int:
    return graph.vertices.count()


def num_edges(graph: Graph) -> int:
    return graph.edges.count()


def graph_counts(graph: Graph) -> DataFrame:
    """One row: ``number_of_vertices``, ``number_of_edges``."""
    # each side is one row, tagged with a constant to meet the other
    vertices = graph.vertices.select(F.lit(1).alias("v"), F.lit(0).alias("e"))
    edges = graph.edges.select(F.lit(0).alias("v"), F.lit(1).alias("e"))
    return vertices.unionAll(edges).agg(
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("number_of_vertices"),
        F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("number_of_edges"),
    )


def num_clusters(graph: Graph, column: str) -> int:
    """Number of distinct values of a cluster property."""
    return graph.vertices.select(column).where(F.col(column).isNotNull()).distinct().count()


def out_degrees(graph: Graph) -> DataFrame:
    """``id, out_degree`` of the vertices that have out-edges; parallel edges count."""
    return graph.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def top_vertices(graph: Graph, column: str, n: int) -> DataFrame:
    """The ``n`` vertices with the highest value, in order, ties by name."""
    ranked = graph.vertices.select(F.col("id").alias("name"), F.col(f"`{column}`"))
    return ranked.orderBy(F.desc(column), F.asc("name")).limit(n)
