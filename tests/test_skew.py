"""Lookups and layouts when one key holds a third of all rows or more."""

import pytest
from pyspark.sql import functions as F

from vertexloom import runtime
from vertexloom.operators import peer_pressure, stars
from vertexloom.operators.lookup import attach
from vertexloom.operators.propagation import laid_out


@pytest.mark.parametrize("with_hot", [False, True])
@pytest.mark.parametrize("key_type", ["string", "bigint"])
def test_attach(spark, with_hot, key_type):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 100).cast(key_type).alias("k"), F.col("id").alias("n")
    )
    table = spark.range(90).select(F.col("id").cast(key_type).alias("key"), (F.col("id") * 10).alias("value"))
    hot = table.where("value = 0") if with_hot else None
    found = attach(rows, "k", table, "found", hot)
    assert found.columns == ["k", "n", "found"]
    # keys 91, 93 ... 99 are not in the table
    assert found.count() == 3_000 - 5 * 30
    assert found.where(F.col("found") != F.col("k").cast("bigint") * 10).count() == 0


@pytest.mark.parametrize("with_hot", [False, True])
def test_attach_with_default(spark, with_hot):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "k string")
    table = spark.createDataFrame([("a", 1), ("b", 2)], "key string, value int")
    hot = table.where("key = 'a'") if with_hot else None
    found = attach(rows, "k", table, "v", hot, missing=0)
    assert sorted(tuple(r) for r in found.collect()) == [("a", 1), ("a", 1), ("b", 2), ("z", 0)]


@pytest.mark.parametrize("broadcast_rows", [100_000, 1])
def test_stars_of_hubs(make_graph, monkeypatch, broadcast_rows):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", broadcast_rows)
    pairs = [("hub", f"v{i % 40}") for i in range(600)] + [("mid", f"v{i}") for i in range(30)] + [("a", "b")]
    with stars(make_graph(pairs), edges_per_star=20) as parts:
        sizes = parts.select(
            "id", (F.size("out_edges") + F.size("in_edges")).alias("n"), F.col("vertex").isNotNull().alias("v")
        ).collect()
    assert sum(r["n"] for r in sizes) == 2 * len(pairs)
    assert all(r["v"] for r in sizes)
    assert sum(r["id"] == "hub" for r in sizes) == 30
    assert max(r["n"] for r in sizes) < 60
    assert {r["id"] for r in sizes} == {v for pair in pairs for v in pair}


def test_hot_rows_spread_over_the_shuffle(spark):
    rows = spark.range(0, 4_000, 1, 4).select(F.lit("hot").alias("k"), F.col("id").alias("n"))
    table = spark.createDataFrame([("hot", 1), ("cold", 2)], "key string, value int")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = attach(rows, "k", table, "found", table.where("key = 'hot'"))
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4_000
    assert max(sizes) < 1_500


def test_out_edges_of_a_hub_are_spread(make_graph):
    pairs = [("hub", f"v{i}") for i in range(3_000)] + [(f"v{i}", "v0") for i in range(300)]
    graph = make_graph(pairs)
    with laid_out(graph, F.col("copies") / F.col("out_degree"), edges_per_hub=1_000) as layout:
        assert layout.vertices.where("is_hub").select("id").collect() == [("hub",)]
        assert layout.edges.count() == 300
        assert layout.hub_edges.count() == 3_000
        weights = layout.hub_edges.agg(F.sum("weight").alias("w")).first()["w"]
        assert weights == pytest.approx(1.0)


def test_keys_follow_names(make_graph):
    graph = make_graph([(n, "z") for n in ["b", "Ä", "a", "B", "aa", "", "😀", "z"]])
    with laid_out(graph, F.col("copies")) as layout:
        rows = layout.vertices.orderBy("key").collect()
    assert [r["id"] for r in rows] == sorted((r["id"] for r in rows), key=lambda name: name.encode())


def test_large_graph_path_without_broadcast_of_names(make_graph, monkeypatch):
    """More vertices than may be broadcast, one cluster with nearly all of them."""
    pairs = [("hub", f"v{i}") for i in range(60)] + [(f"v{i}", "hub") for i in range(20)] + [("x", "y")]
    graph = make_graph(pairs)
    expected = {r["id"]: r["c"] for r in peer_pressure(graph, "c", max_iter=4).graph.vertices.collect()}
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 5)
    found = peer_pressure(graph, "c", max_iter=4, edges_per_hub=10)
    assert {r["id"]: r["c"] for r in found.graph.vertices.collect()} == expected


def test_a_long_id_leaves_hubs_spread(spark, make_graph, monkeypatch):
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 1_000)
    pairs = [("hub", f"v{i}") for i in range(3_000)] + [("x" * 1_000_000, "v0")]
    with laid_out(make_graph(pairs), F.lit(1.0), edges_per_hub=100) as layout:
        assert layout.hub_size == 100
        assert layout.hub_edges.count() == 3_000
        assert layout.edges.count() == 1


def test_unknown_ends_raise(spark, make_graph):
    graph = make_graph([("a", "b")])
    loose = graph.with_vertices(graph.vertices.where("id = 'a'"))
    with pytest.raises(ValueError, match="ends"):
        with laid_out(loose, F.lit(1.0)):
            pass
