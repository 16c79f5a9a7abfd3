"""Building and maintaining graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexloom import runtime
from vertexloom.graph import Graph, labels_of, property_column
from vertexloom.operators.lookup import attach
from vertexloom.runtime import broadcastable_id, checkpoint, fits_broadcast


def project_edges(
    rows: DataFrame, src: str, dst: str, properties: Sequence[str] = (), keep_endpoints: bool = True
) -> DataFrame:
    """Edges ``(src, dst, properties...)`` from a table of any shape.

    The endpoint columns are edge properties too unless ``keep_endpoints`` is
    off; they keep their values when an edge is reversed later.
    """
    wanted = [p for p in properties if p]
    if keep_endpoints:
        if src not in wanted:
            wanted.insert(0, src)
        if dst not in wanted:
            wanted.insert(1, dst)
    missing = [c for c in (src, dst, *wanted) if c not in rows.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return rows.select(
        rows[f"`{src}`"].cast("string").alias("src"),
        rows[f"`{dst}`"].cast("string").alias("dst"),
        *[rows[f"`{p}`"].alias(property_column(p)) for p in wanted],
    )


def both_directions(edges: DataFrame) -> DataFrame:
    """Every edge and its reverse, with the same property values."""
    # exploding in place reads the input once, a union would read it twice
    forward = F.struct(F.col("src").alias("a"), F.col("dst").alias("b"))
    backward = F.struct(F.col("dst").alias("a"), F.col("src").alias("b"))
    others = [F.col(f"`{c}`") for c in edges.columns if c not in ("src", "dst", "edge_id")]
    return edges.select(F.explode(F.array(forward, backward)).alias("_ends"), *others).select(
        F.col("_ends.a").alias("src"), F.col("_ends.b").alias("dst"), *others
    )


def endpoints(edges: DataFrame) -> DataFrame:
    """Distinct vertex ids at either end of the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def graph_from_edges(edges: DataFrame, *, directed: bool, name: str | None = None) -> Graph:
    """Graph whose vertices are the endpoints of ``edges`` (``src``, ``dst``, properties).

    An edge without one of its ends creates nothing.
    """
    vertex_label, edge_label = labels_of(name)
    edges = _with_ends(edges.withColumns({"src": F.col("src").cast("string"), "dst": F.col("dst").cast("string")}))
    vertices = endpoints(edges).withColumn("label", F.lit(vertex_label))
    if not directed:
        edges = both_directions(edges)
    return Graph(vertices, edges.withColumn("label", F.lit(edge_label)), name)


def _with_ends(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def relabel(graph: Graph) -> Graph:
    """Give all vertices and edges the labels that follow from the graph's name."""
    vertex_label, edge_label = labels_of(graph.name)
    return Graph(
        graph.vertices.withColumn("label", F.lit(vertex_label)),
        graph.edges.withColumn("label", F.lit(edge_label)),
        graph.name,
    )


def new_vertices(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose id does not exist yet."""
    return candidates.join(existing.select("id"), "id", "left_anti")


def add_vertices(graph: Graph, ids: DataFrame) -> Graph:
    """Insert the ids that are not there; the ones that are stay as they are."""
    label = labels_of(graph.name)[0]
    candidates = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    fresh = new_vertices(graph.vertices, candidates).withColumn("label", F.lit(label))
    return graph.with_vertices(graph.vertices.unionByName(fresh, allowMissingColumns=True))


def ensure_endpoints(graph: Graph) -> Graph:
    return add_vertices(graph, endpoints(graph.edges))


def add_edges(graph: Graph, edges: DataFrame, *, check: bool) -> Graph:
    """Append edges (``src``, ``dst``, properties).

    With ``check`` missing endpoints are created first; without it an edge with
    a missing endpoint is not added. Edges whose end is NULL are never added. In
    a graph with weights, an added edge without one weighs 1.0.
    """
    edges = _with_ends(edges)
    if "weight" in graph.edges.columns:
        weight = F.col("weight") if "weight" in edges.columns else F.lit(None)
        kind = graph.edges.schema["weight"].dataType
        edges = edges.withColumn("weight", F.coalesce(weight, F.lit(1.0).cast(kind)))
    if check:
        graph = add_vertices(graph, endpoints(edges))
    else:
        edges = _between_known(edges, graph.vertices)
    added = edges.withColumn("label", F.lit(labels_of(graph.name)[1]))
    return graph.with_edges(graph.edges.unionByName(added, allowMissingColumns=True))


def _between_known(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    # Asking for the distinct endpoints that are missing shuffles one row per
    # name instead of one per edge, and usually few or none are missing, or all at one
    # end. They are found once, for both ends, and kept: whatever edges and vertices derive
    # from is not read again for each question about them.
    each = F.explode(F.array(*[F.struct(F.lit(e).alias("end"), F.col(e).alias("id")) for e in ("src", "dst")]))
    named = edges.select(each.alias("u")).select("u.end", "u.id").distinct()
    unknown = checkpoint(named.join(vertices.select("id"), "id", "left_anti"))
    for end in ("src", "dst"):
        ids, small = _sized(unknown.where(F.col("end") == end))
        if small != 0:
            edges = _by_id(edges, (end,), False, ids, small)
    return edges


def _without_ends_in(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges that have neither end in ``ids``."""
    ids, small = _sized(ids)
    if small == 0:
        return edges
    return _by_id(edges, ("src", "dst"), False, ids, small)


def _sized(ids: DataFrame) -> tuple[DataFrame, int | None]:
    """The ids and how many there are; None if they are too many to broadcast.

    Few ids become a table of their own, so nothing has to be kept in memory for them.
    """
    ids = ids.select("id")
    rows = ids.limit(runtime.BROADCAST_ROWS + 1) if fits_broadcast(ids) else None
    found = rows.collect() if rows is not None else None
    if found is None or len(found) > runtime.BROADCAST_ROWS:
        return ids, None
    return ids.sparkSession.createDataFrame(found, ids.schema), len(found)


def _by_id(edges: DataFrame, ends: Sequence[str], keep: bool, ids: DataFrame, small: int | None) -> DataFrame:
    """Edges that have all of their ``ends`` among the ids (``keep``), or none of them."""
    how = "left_semi" if keep else "left_anti"
    if small is not None:
        for end in ends:
            edges = edges.join(F.broadcast(ids.select(F.col("id").alias(end))), end, how).select(*edges.columns)
        return edges
    # Many ids: a shuffle join, with the ends of very many edges answered by broadcast.
    frequent = _frequent(edges, ends)
    listed = ids.select("id", F.lit(True).alias("listed"))
    for end in ends:
        hot = listed.join(F.broadcast(frequent.where(F.col("end") == end).select("id")), "id")
        found = attach(edges, end, listed, "_listed", hot, missing=False)
        edges = found.where(F.col("_listed") == F.lit(keep)).select(*edges.columns)
    return edges


def _frequent(edges: DataFrame, ends: Sequence[str]) -> DataFrame:
    """``end``, ``id`` of the names that very many edges have at an end; one pass over the edges for all ends.

    At most ``BROADCAST_ROWS`` names of an end can stand at more than that share of the
    edges, and only short ones count, so the list is bounded.
    """
    often = edges.count() // max(1, runtime.BROADCAST_ROWS)
    each = F.explode(F.array(*[F.struct(F.lit(e).alias("end"), F.col(e).alias("id")) for e in ends])).alias("u")
    uses = edges.select(each).groupBy("u.end", "u.id").agg(F.count(F.lit(1)).alias("n"))
    found = uses.where((F.col("n") > often) & broadcastable_id()).select("end", "id").collect()
    return edges.sparkSession.createDataFrame(found, "end string, id string")


def clear_edges(graph: Graph) -> Graph:
    """Drop all edges, keep the vertices."""
    return graph.with_edges(graph.edges.limit(0))


def clear_vertices(graph: Graph, condition: Column | None = None) -> Graph:
    """Drop vertices (all, or those that meet a condition) and their edges."""
    if condition is None:
        return Graph(graph.vertices.limit(0), graph.edges.limit(0), graph.name)
    dropped = F.coalesce(condition, F.lit(False))
    edges = _without_ends_in(graph.edges, graph.vertices.where(dropped).select("id"))
    return Graph(graph.vertices.where(~dropped), edges, graph.name)


def with_property(graph: Graph, values: DataFrame, column: str, unique: bool = False) -> Graph:
    """Write ``values`` (``id``, ``column``) onto the vertices; all vertices stay.

    Of several values for an id the largest counts (any, where a type has no order).
    ``unique`` says that no id has several, which saves bringing them together.
    """
    kept = graph.vertices.drop(column)
    one = values.select("id", F.col(f"`{column}`"))
    if not unique:
        one = one.groupBy("id").agg(one_of(values, column).alias(column))
    return graph.with_vertices(kept.join(one, "id", "left"))


def one_of(rows: DataFrame, column: str) -> Column:
    """Aggregate that picks one non-NULL value: the largest if the type has an order."""
    kind = rows.schema[column].dataType.simpleString()
    name = F.col(f"`{column}`")
    return F.first(name, ignorenulls=True) if "map<" in kind or "variant" in kind else F.max(name)


def merge_vertices(vertices: DataFrame) -> DataFrame:
    """One row per id from rows that may repeat it.

    Each property is taken on its own: the value that some row has, the largest if
    rows differ.
    """
    others = [c for c in vertices.columns if c != "id"]
    if not others:
        return vertices.distinct()
    return vertices.groupBy("id").agg(*[one_of(vertices, c).alias(c) for c in others])


def split_graph(graph: Graph, conditions: Sequence[Column]) -> list[Graph]:
    """One part per condition: the vertices that meet it and their out-edges."""
    parts = []
    for condition in conditions:
        vertices = graph.vertices.where(condition)
        ids, small = _sized(vertices)
        parts.append(Graph(vertices, _by_id(graph.edges, ("src",), True, ids, small), graph.name))
    return parts


def edges_of(edges: DataFrame, values: DataFrame) -> DataFrame:
    """Edges whose source is in ``values`` (``id``, one more column; ids are distinct), with that column."""
    column = values.columns[1]
    if fits_broadcast(values):
        return attach(edges, "src", F.broadcast(values), column)
    hot = values.join(F.broadcast(_frequent(edges, ["src"]).select("id")), "id")
    return attach(edges, "src", values, column, hot)


def with_edge_ids(edges: DataFrame, path: str) -> DataFrame:
    """Give each edge row a distinct BIGINT ``edge_id``; an existing one is replaced.

    The numbers depend on where a row happens to be, so the edges are written
    to ``path``, and every later read sees the same ones.
    """
    numbered = edges.drop("edge_id").withColumn("edge_id", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return edges.sparkSession.read.parquet(path)
