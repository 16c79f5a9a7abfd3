"""Queries that read the edges of a graph several times derive them once.

Here the edges differ whenever they are derived, so that vertices and edges of two
derivations never fit each other.
"""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vertexloom.operators import add_edges, graph_from_edges
from vertexloom.operators.construct import endpoints
from vertexloom.sources import load_graph

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def changing(monkeypatch):
    draw = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()

    def edges(spark, folder):
        ends = [F.concat(F.lit(kind), draw()).alias(end) for kind, end in (("c", "src"), ("s", "dst"))]
        return spark.range(20).select(*ends, F.lit(1.0).alias("weight"))

    for name in entry.GRAPHS:
        monkeypatch.setitem(entry.GRAPHS, name, edges)


def ids(frame):
    return sorted(row[0] for row in frame.collect())


def test_named_graphs(spark, changing):
    root, counts = entry.two_named_graphs(spark, FOLDER)
    for name in counts:
        graph = load_graph(spark, root, name)
        assert ids(graph.vertices.select("id")) == ids(endpoints(graph.edges))


@pytest.mark.parametrize("query", ["graphson_roundtrip", "split_and_merge"])
def test_written_and_read(spark, changing, query):
    rows = entry.queries()[query](spark, FOLDER).collect()
    ends = {name for row in rows if row["kind"] == "edge" for name in (row["a"], row["b"])}
    assert ends == {row["a"] for row in rows if row["kind"] == "vertex"}
    assert len(ends) == 40


@pytest.mark.parametrize(
    "query",
    [
        "merge_properties",
        "pagerank_nation",
        "pagerank_trade",
        "pagerank_actions",
        "peer_pressure_unit",
        "peer_pressure_distributed",
    ],
)
def test_one_row_per_vertex(spark, changing, query):
    frame = entry.queries()[query](spark, FOLDER)
    rows = frame.collect()
    assert len(rows) == 40
    if query not in ("merge_properties",):
        assert all(row[1] is not None for row in rows)


def test_top_of_the_vertices_ranked(spark, changing):
    assert all(row["pagerank"] is not None for row in entry.pagerank_top(spark, FOLDER).collect())


def test_adjacency(spark, changing):
    rows = entry.adjacency(spark, FOLDER).collect()
    out = {(row["id"], row["neighbour"]) for row in rows if row["direction"] == "out"}
    assert len(out) == 20
    assert out == {(row["neighbour"], row["id"]) for row in rows if row["direction"] == "in"}


def test_unknown_ends_are_found_once(spark, tmp_path, monkeypatch):
    """The added edges do not read the vertices again, and only the end with unknown names is looked up."""
    monkeypatch.setattr("vertexloom.runtime.BROADCAST_ROWS", 2)
    schema = "src string, dst string, weight double"
    spark.createDataFrame([("a", "x", 1.0)], schema).write.parquet(str(tmp_path / "known"))
    more = [(src, "x", 1.0) for src in "abcdefg"]
    spark.createDataFrame(more, schema).write.parquet(str(tmp_path / "more"))
    known, more = (spark.read.parquet(str(tmp_path / name)) for name in ("known", "more"))
    # vertices from a frame of their own, so that its files are told from those of the edges
    known.select("src").union(known.select("dst")).toDF("id").write.parquet(str(tmp_path / "vertices"))
    graph = graph_from_edges(known, directed=True)
    vertices = spark.read.parquet(str(tmp_path / "vertices")).withColumn("label", F.lit("SimpleV"))
    added = add_edges(graph.with_vertices(vertices), more, check=False).edges
    assert sorted(row["src"] for row in added.collect()) == ["a", "a"]
    assert not any("/vertices/" in file for file in added.inputFiles())
