"""Graphs as adjacency JSON."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vertexloom.operators import graph_from_edges, stars, with_property
from vertexloom.sources import read_graphson, staged_graphson, write_graphson

PAIRS = [
    ("a", "b", 0.5, 1, "x"),
    ("a", "b", 0.5, 1, "x"),
    ("b", "b", None, 2, 'quo"te'),
    ('{"@value": 3}', "ü,\n", 1e-7, None, None),
    ("a", "c", 0.30000000000000004, -5, ""),
]


@pytest.fixture(scope="module")
def graph(spark):
    edges = spark.createDataFrame(PAIRS, "src string, dst string, weight double, n int, note string")
    graph = graph_from_edges(edges, directed=True, name="g")
    scores = graph.vertices.select("id", F.length("id").cast("double").alias("score"), F.lit(7).alias("n"))
    return with_property(with_property(graph, scores, "score"), scores.where("id <> 'a'"), "n")


def rows_of(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("edges_per_line", [100_000, 2])
def test_round_trip(spark, tmp_path, graph, edges_per_line):
    path = str(tmp_path / "g")
    write_graphson(graph, path, edges_per_line)
    back = read_graphson(spark, path)
    columns = ["src", "dst", "label", "weight", "n", "note"]
    assert rows_of(back.edges, *columns) == rows_of(graph.edges, *columns)
    assert dict(back.edges.dtypes) | {"weight": "double", "n": "int", "note": "string"} == dict(back.edges.dtypes)
    assert rows_of(back.vertices, "id", "label", "score", "n") == rows_of(graph.vertices, "id", "label", "score", "n")
    assert rows_of(back.vertices, "name") == rows_of(graph.vertices, "id")


def test_lines(spark, tmp_path, graph):
    path = str(tmp_path / "g")
    write_graphson(graph, path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    by_id = {line["id"]: line for line in lines}
    assert len(by_id) == len(lines) == 5
    b = by_id["b"]
    assert b["label"] == "g-V"
    assert [e["inV"] for e in b["outE"]["g-E"]] == ["b"]
    assert sorted(e["outV"] for e in b["inE"]["g-E"]) == ["a", "a", "b"]
    assert b["properties"]["score"][0]["value"] == {"@type": "g:Double", "@value": 1.0}
    assert b["properties"]["n"][0]["value"] == {"@type": "g:Int32", "@value": 7}
    assert "n" not in by_id["a"]["properties"]
    assert "outE" not in by_id["c"]
    outs = {e["id"]["@value"]: e["inV"] for line in lines for e in line.get("outE", {}).get("g-E", [])}
    ins = {e["id"]["@value"]: line["id"] for line in lines for e in line.get("inE", {}).get("g-E", [])}
    assert outs == ins and len(outs) == len(PAIRS)


def test_hub_is_split(spark, graph):
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    with stars(graph, edges_per_star=2) as parts:
        rows = parts.collect()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() >= kept
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    found = {}
    for r in rows:
        assert r["vertex"]["id"] == r["id"]
        found.setdefault(r["id"], []).append((r["part"], r["parts"]))
    assert {k: sorted(v) for k, v in found.items()} == {
        "a": [(0, 2), (1, 2)],
        "b": [(0, 2), (1, 2)],
        "c": [(0, 1)],
        "ü,\n": [(0, 1)],
        '{"@value": 3}': [(0, 1)],
    }
    for edges in ("out_edges", "in_edges"):
        assert sum(len(r[edges]) for r in rows) == len(PAIRS)


def test_lines_tell_how_many_they_are(spark, tmp_path, graph):
    write_graphson(graph, str(tmp_path / "g"), edges_per_line=2)
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "g")).collect()]
    by_id = {}
    for line in lines:
        by_id.setdefault(line["id"], []).append((line["part"], line["parts"]))
    assert all(sorted(found) == [(i, len(found)) for i in range(len(found))] for found in by_id.values())
    assert len(by_id["a"]) == 2 and len(by_id["c"]) == 1


@pytest.mark.parametrize("damage", ["lost", "doubled", "swapped", "single doubled"])
@pytest.mark.parametrize("given", [False, True])
def test_incomplete_lines_raise(spark, tmp_path, make_graph, damage, given):
    hub = make_graph([("hub", f"v{i}") for i in range(10)])
    write_graphson(hub, str(tmp_path / "g"), edges_per_line=3)
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "g")).collect()]
    parts = [line for line in lines if json.loads(line)["id"] == "hub"]
    assert len(parts) == 4
    others = [line for line in lines if line not in parts]
    kept = {
        "lost": [*others, *parts[1:]],
        "doubled": [*others, *parts, parts[0]],
        "swapped": [*others, *parts[1:], parts[1]],
        "single doubled": [*others, *parts, others[0]],
    }[damage]
    (tmp_path / "in").mkdir()
    for i, line in enumerate(kept):
        (tmp_path / "in" / f"part-{i}").write_text(line)
    types = {"vertex_properties": {}, "edge_properties": {}} if given else {}
    with pytest.raises(Exception, match="incomplete"):
        read_graphson(spark, str(tmp_path / "in"), **types).vertices.collect()


def test_a_vertex_of_two_files_is_complete_in_each(spark, tmp_path, make_graph):
    write_graphson(make_graph([("hub", f"v{i}") for i in range(10)]), str(tmp_path / "a"), edges_per_line=3)
    write_graphson(make_graph([("hub", "v1"), ("hub", "w"), ("w", "w")]), str(tmp_path / "b"), edges_per_line=1)
    both = read_graphson(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert both.edges.count() == 13 and both.vertices.count() == 12


def test_text_is_parsed_once(spark, tmp_path, graph):
    write_graphson(graph, str(tmp_path / "g"))
    back = read_graphson(spark, str(tmp_path / "g"))
    for frame in (back.vertices, back.edges):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Scan text" not in plan and "from_json" not in plan and "FileScan parquet" in plan
    with staged_graphson(spark, str(tmp_path / "g")) as staged:
        assert rows_of(staged.edges, "src", "dst", "note") == rows_of(graph.edges, "src", "dst", "note")
        folder = staged.edges.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert "vertexloom-lines" in folder and Path(folder).exists()
    assert not Path(folder).exists()


def test_typed_ids_and_shared_edges(spark, tmp_path):
    """Star vertices with number ids; an edge stands in both of its stars."""

    def number(value):
        return {"@type": "g:Int32", "@value": value}

    def star(vertex, outs, ins):
        return {
            "id": number(vertex),
            "label": "v",
            "outE": {"e": [{"id": number(i), "inV": number(v)} for i, v in outs]},
            "inE": {"e": [{"id": number(i), "outV": number(v)} for i, v in ins]},
            "properties": {"name": [{"id": number(0), "value": f"v{vertex}"}]},
        }

    lines = [star(1, [(1, 2), (2, 3)], [(3, 2)]), star(2, [(3, 1)], [(1, 1)]), star(3, [], [(2, 1)])]
    (tmp_path / "part-0").write_text("\n".join(map(json.dumps, lines[:2])) + "\n\n")
    (tmp_path / "part-1").write_text(json.dumps(lines[2]))
    graph = read_graphson(spark, str(tmp_path), edge_ids=True)
    assert rows_of(graph.vertices, "id", "name") == [("1", "v1"), ("2", "v2"), ("3", "v3")]
    assert rows_of(graph.edges, "edge_id", "src", "dst") == [("1", "1", "2"), ("2", "1", "3"), ("3", "2", "1")]


def test_given_types(spark, tmp_path, graph):
    path = str(tmp_path / "g")
    write_graphson(graph, path)
    back = read_graphson(spark, path, vertex_properties={"score": "double"}, edge_properties={"n": "string"})
    assert back.vertices.columns == ["id", "label", "score"]
    assert dict(back.edges.dtypes)["n"] == "string"


def test_bad_line_raises(spark, tmp_path):
    (tmp_path / "part-0").write_text('{"id": "a"\n')
    with pytest.raises(Exception):
        read_graphson(spark, str(tmp_path), vertex_properties={}, edge_properties={}).vertices.collect()


def test_several_edge_labels(spark, tmp_path, graph):
    two = graph.with_edges(graph.edges.withColumn("label", F.when(F.col("src") == "a", "x").otherwise("y")))
    write_graphson(two, str(tmp_path / "g"))
    back = read_graphson(spark, str(tmp_path / "g"))
    assert rows_of(back.edges, "src", "dst", "label") == rows_of(two.edges, "src", "dst", "label")


def test_property_names_like_columns_or_differing_in_case(spark, tmp_path):
    """No value is lost on read, and names come back on write."""

    def value(v):
        return [{"id": {"@type": "g:Int64", "@value": 0}, "value": v}]

    on_vertex = {"id": "i", "label": "l", "Name": "big", "name": "small", "NAME": "huge"}
    line = {
        "id": "a",
        "label": "v",
        "properties": {k: value(v) for k, v in on_vertex.items()},
        "outE": {"e": [{"id": "1", "inV": "a", "properties": {"src": "s", "Src": "S", "w": "x"}}]},
    }
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0").write_text(json.dumps(line))
    graph = read_graphson(spark, str(tmp_path / "in"))
    vertex, edge = graph.vertices.first().asDict(), graph.edges.first().asDict()
    assert (vertex["id"], vertex["label"], vertex["id__prop"], vertex["label__prop"]) == ("a", "v", "i", "l")
    assert sorted(vertex.values()) == sorted([*on_vertex.values(), "a", "v"])
    assert sorted(edge.values()) == sorted(["a", "a", "e", "s", "S", "x"])
    write_graphson(graph, str(tmp_path / "out"))
    back = json.loads(spark.read.text(str(tmp_path / "out")).first()["value"])
    assert {k: v[0]["value"] for k, v in back["properties"].items()} == on_vertex
    assert back["outE"]["e"][0]["properties"] == {"src": "s", "Src": "S", "w": "x"}


def test_lines_are_compressed(spark, tmp_path, make_graph):
    graph = make_graph([("a", "b"), ("b", "c")])
    write_graphson(graph, str(tmp_path / "g"))
    write_graphson(graph, str(tmp_path / "plain"), compression="none")
    assert {p.name.endswith(".txt.gz") for p in (tmp_path / "g").glob("part-*")} == {True}
    assert {p.name.endswith(".txt") for p in (tmp_path / "plain").glob("part-*")} == {True}
    assert rows_of(spark.read.text(str(tmp_path / "g")), "value") == rows_of(
        spark.read.text(str(tmp_path / "plain")), "value"
    )


def test_vertices_from_the_edges_written(spark, tmp_path):
    """With endpoints_only the edges are derived once, so random ones fit their vertices."""
    draw = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()
    edges = spark.range(20).select(draw().alias("src"), draw().alias("dst"))
    write_graphson(graph_from_edges(edges, directed=True), str(tmp_path / "g"), endpoints_only=True)
    back = read_graphson(spark, str(tmp_path / "g"))
    assert back.vertices.count() == 40
    assert back.edges.count() == 20


def test_an_edge_is_a_row_of_the_staged_table(spark, tmp_path, make_graph):
    """Parquet is read in batches of thousands of rows, so no row may hold the edges of a line."""
    write_graphson(make_graph([("a", "b")] * 50 + [("b", "c")] * 30), str(tmp_path / "g"), edges_per_line=20)
    with staged_graphson(spark, str(tmp_path / "g")) as staged:
        table = spark.read.parquet(*staged.edges.inputFiles())
        assert table.count() >= 80
        assert staged.edges.count() == 80 and staged.vertices.count() == 3
    back = read_graphson(spark, str(tmp_path / "g"), edge_ids=True)
    assert back.edges.columns == ["edge_id", "src", "dst", "label", "weight"]
    assert back.edges.select("edge_id").distinct().count() == 80


def test_staged_lines_are_those_of_the_text(spark, tmp_path):
    """Labels without edges, missing edges and vertices without any give the same rows either way."""
    edge = {"id": 1, "inV": "b", "properties": {"w": {"@type": "g:Int32", "@value": 3}}}
    out_edges = [
        {"e": [], "f": [edge, edge]},
        {"e": [edge], "f": [], "g": [{"id": 2, "inV": "a", "properties": None}]},
        {"e": None, "f": [{"id": 3, "inV": "c"}]},
        {"e": [None]},
        {"e": []},
        {},
        None,
    ]
    lines = [{"id": f"v{i}", "label": "v", "outE": outs} for i, outs in enumerate(out_edges)] + [{"id": "b", "label": "v"}]
    for line in lines[::2]:
        line["properties"] = {"p": [{"id": 0, "value": line["id"]}]}
    (tmp_path / "part-0").write_text("\n".join(map(json.dumps, lines)))
    staged = read_graphson(spark, str(tmp_path), edge_ids=True)
    given = read_graphson(
        spark, str(tmp_path), vertex_properties={"p": "string"}, edge_properties={"w": "int"}, edge_ids=True
    )
    for one, other in ((staged.vertices, given.vertices), (staged.edges, given.edges)):
        assert one.dtypes == other.dtypes
        assert rows_of(one, *one.columns) == rows_of(other, *other.columns)
    assert staged.vertices.count() == 8 and staged.edges.count() == 6
