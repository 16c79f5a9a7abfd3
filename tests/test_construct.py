"""Construction, maintenance, selection."""

import pytest
from pyspark.sql import functions as F

from vertexloom import runtime
from vertexloom.operators import (
    add_edges,
    add_vertices,
    clear_edges,
    clear_vertices,
    graph_counts,
    graph_from_edges,
    has,
    has_label,
    merge_vertices,
    num_clusters,
    num_edges,
    num_vertices,
    out_degrees,
    top_vertices,
    value_map,
    vertex_table,
    with_property,
)
from vertexloom.plans import maintain


def pairs_of(graph):
    return sorted((r["src"], r["dst"]) for r in graph.edges.collect())


def ids_of(graph):
    return sorted(r["id"] for r in graph.vertices.collect())


def edges_frame(spark, *pairs):
    return spark.createDataFrame([(a, b, 2.0) for a, b in pairs], "src string, dst string, weight double")


def test_parallel_edges_and_loops(make_graph):
    graph = make_graph([("a", "a"), ("a", "b"), ("a", "b")], directed=False, name="g")
    assert (num_vertices(graph), num_edges(graph)) == (2, 6)
    assert pairs_of(graph) == [("a", "a")] * 2 + [("a", "b")] * 2 + [("b", "a")] * 2
    counts = graph_counts(graph).first()
    assert (counts["number_of_vertices"], counts["number_of_edges"]) == (2, 6)
    assert has_label(graph.edges, "g-E").count() == 6
    assert has_label(graph.edges, "h-E").count() == 0


def test_empty_edge_table(spark, make_graph):
    graph = make_graph([])
    counts = graph_counts(graph).first()
    assert (counts["number_of_vertices"], counts["number_of_edges"]) == (0, 0)


def test_number_endpoints(spark):
    graph = graph_from_edges(spark.sql("SELECT 1 AS src, 2L AS dst"), directed=True)
    assert ids_of(graph) == ["1", "2"]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_add_edges(spark, make_graph, monkeypatch, broadcast_rows):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", broadcast_rows)
    graph = make_graph([("a", "b"), ("b", "c")])
    more = edges_frame(spark, ("a", "b"), ("a", "x"), ("y", "b"), ("c", "a"))
    unchecked = add_edges(graph, more, check=False)
    assert pairs_of(unchecked) == [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a")]
    assert ids_of(unchecked) == ["a", "b", "c"]
    checked = add_edges(graph, more, check=True)
    assert num_edges(checked) == 6
    assert ids_of(checked) == ["a", "b", "c", "x", "y"]
    assert {r["label"] for r in checked.edges.collect()} == {"SimpleE"}


def test_add_vertices_is_idempotent(spark, make_graph):
    graph = make_graph([("a", "b")])
    scored = with_property(graph, graph.vertices.withColumn("score", F.lit(1.0)), "score")
    names = spark.createDataFrame([("b",), ("c",), ("c",)], "name string")
    again = add_vertices(add_vertices(scored, names), names)
    assert {r["id"]: r["score"] for r in again.vertices.collect()} == {"a": 1.0, "b": 1.0, "c": None}


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_clear(make_graph, monkeypatch, broadcast_rows):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", broadcast_rows)
    graph = make_graph([("a", "b"), ("b", "c"), ("c", "d"), ("d", "d")])
    some = clear_vertices(graph, F.col("id") == "b")
    assert (ids_of(some), pairs_of(some)) == (["a", "c", "d"], [("c", "d"), ("d", "d")])
    none = clear_vertices(graph, F.col("id") == "z")
    assert (num_vertices(none), num_edges(none)) == (4, 4)
    everything = clear_vertices(graph)
    assert (num_vertices(everything), num_edges(everything)) == (0, 0)
    assert everything.edges.columns == graph.edges.columns
    edges = clear_edges(graph)
    assert (num_vertices(edges), num_edges(edges)) == (4, 0)


def test_unknown_condition_drops_nothing(make_graph):
    graph = make_graph([("a", "b")])
    empty = with_property(graph, graph.vertices.select("id", F.lit(None).cast("int").alias("n")), "n")
    assert num_vertices(clear_vertices(empty, F.col("n") > 1)) == 2


def test_with_property_replaces_and_keeps_all(spark, make_graph):
    graph = make_graph([("a", "b")])
    values = spark.createDataFrame([("a", 1)], "id string, n int")
    once = with_property(graph, values, "n")
    twice = with_property(once, values.withColumn("n", F.lit(5)), "n")
    assert {r["id"]: r["n"] for r in twice.vertices.collect()} == {"a": 5, "b": None}


def test_merge_keeps_every_property(spark):
    rows = spark.createDataFrame(
        [("a", "v", None, "z"), ("a", "v", 1, None), ("b", "v", None, None)], "id string, label string, n int, t string"
    )
    assert sorted(tuple(r) for r in merge_vertices(rows).collect()) == [("a", "v", 1, "z"), ("b", "v", None, None)]


def test_write_back_of_several_values_keeps_one_vertex(spark, make_graph):
    values = spark.createDataFrame([("a", 1), ("a", 3), ("a", None)], "id string, n int")
    graph = with_property(make_graph([("a", "b")]), values, "n")
    assert sorted(tuple(r) for r in graph.vertices.select("id", "n").collect()) == [("a", 3), ("b", None)]


@pytest.mark.parametrize("check", [True, False])
def test_added_edges_weigh_one_and_have_both_ends(spark, make_graph, check):
    edges = spark.createDataFrame([("a", "b"), ("a", None), (None, "b")], "src string, dst string")
    graph = add_edges(make_graph([("a", "b")]), edges, check=check)
    assert [tuple(r) for r in graph.edges.select("src", "dst", "weight").collect()] == [("a", "b", 1.0)] * 2
    assert graph.vertices.count() == 2
    assert graph_from_edges(edges, directed=True).vertices.count() == 2


def test_select(spark, make_graph):
    graph = make_graph([("a", "b"), ("a", "c"), ("a", "b")])
    values = spark.createDataFrame([("a", 2.0, "x"), ("b", 2.0, None), ("c", 3.0, "x")], "id string, r double, t string")
    graph = with_property(with_property(graph, values, "r"), values, "t")
    assert [r["name"] for r in top_vertices(graph, "r", 2).collect()] == ["c", "a"]
    assert has(graph.vertices, "t", "x").count() == 2
    assert has(graph.vertices, "id", within=["a", "z"]).count() == 1
    assert {r["id"]: r["out_degree"] for r in out_degrees(graph).collect()} == {"a": 3}
    assert num_clusters(graph, "t") == 1
    assert value_map(graph).columns == ["id", "r", "t"]
    maps = {r["id"]: r["properties"] for r in value_map(graph, ["t"], as_map=True).collect()}
    assert maps == {"a": {"t": "x"}, "b": {}, "c": {"t": "x"}}
    assert vertex_table(graph, ["r"]).columns == ["name", "r"]


def test_maintain(spark, make_graph):
    names = spark.createDataFrame([(n,) for n in "abcde"], "id string")
    edges = edges_frame(spark, ("a", "b"), ("b", "c"), ("c", "a"))
    graph, counts = maintain(make_graph([("x", "y")]), names, edges)
    assert list(counts.values()) == [0, 5, 0, 3]


def test_partition_sizing(spark):
    assert runtime.partitions_for(spark, 0) == 2
    assert runtime.partitions_for(spark, 10_000_000_000) == 5_000
    assert runtime.partitions_for(spark, 10**13) == runtime.MAX_PARTITIONS


def test_broadcast_bounds(spark, monkeypatch):
    ids = spark.range(20).select(F.col("id").cast("string").alias("id"))
    assert runtime.fits_broadcast(ids)
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 29)
    assert not runtime.fits_broadcast(ids)


def test_planning_restores_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    with pytest.raises(KeyError):
        with runtime.planning(spark, partitions=3, adaptive=False):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise KeyError
    assert before == (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled"))
