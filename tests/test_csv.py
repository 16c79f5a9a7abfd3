"""Edge lists and vertex tables as CSV."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vertexloom.operators import graph_from_edges, project_edges, with_property
from vertexloom.runtime import refuse_same_path
from vertexloom.sources import (
    infer_schema,
    read_edges_csv,
    read_edges_dir,
    read_rows_dir,
    read_schema,
    write_schema,
    write_vertices_csv,
    write_vertices_dir,
)

NAMES = ["plain", "co,mma", 'quo"te', " spaced ", "ünï", "", "back\\slash", "'single'"]


def rows_of(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def edge_dir(tmp_path, data, schema):
    (tmp_path / "data.csv").write_text(data, encoding="utf-8")
    (tmp_path / "schema").write_text(schema, encoding="utf-8")
    return str(tmp_path)


def test_header_csv(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text('w,src,dst\n2.5,a,"b, the ""second"""\n,b,c\n1e-3,c,\n', encoding="utf-8")
    edges = read_edges_csv(spark, str(path), "src", "dst", "w")
    assert edges.columns == ["src", "dst", "weight"]
    assert rows_of(edges, "src", "dst", "weight") == [
        ("a", 'b, the "second"', 2.5),
        ("b", "c", 1.0),
        ("c", "", 0.001),
    ]


def test_short_row_has_default_weight(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("src,dst,weight\na,b\nb,c,3\n")
    assert rows_of(read_edges_csv(spark, str(path), "src", "dst", "weight"), "weight") == [(1.0,), (3.0,)]


@pytest.mark.parametrize("weight", [None, "absent"])
def test_weight_not_in_file(spark, tmp_path, weight):
    path = tmp_path / "edges.csv"
    path.write_text("src,dst\na,b\n")
    assert rows_of(read_edges_csv(spark, str(path), "src", "dst", weight), "weight") == [(1.0,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_weight_raises(spark, tmp_path, ansi):
    path = tmp_path / "edges.csv"
    path.write_text("src,dst,weight\na,b,heavy\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a double: heavy"):
            read_edges_csv(spark, str(path), "src", "dst", "weight").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_missing_endpoint_column(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="dst"):
        read_edges_csv(spark, str(path), "a", "dst")


def test_line_break_in_field(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text('src,dst\n"two\nlines",b\n')
    assert rows_of(read_edges_csv(spark, str(path), "src", "dst", multiline=True), "src") == [("two\nlines",)]


def test_edge_dir(spark, tmp_path):
    path = edge_dir(tmp_path, "a,b,1.0\nc,d,2.0\n", "p1:String\np2:String\nweight:Double\n")
    edges = read_edges_dir(spark, path, "p1", "p2", ["weight"])
    assert edges.columns == ["src", "dst", "p1", "p2", "weight"]
    assert rows_of(edges, *edges.columns) == [("a", "b", "a", "b", 1.0), ("c", "d", "c", "d", 2.0)]
    assert read_edges_dir(spark, path, "p1", "p2", ["weight"], keep_endpoints=False).columns == [
        "src",
        "dst",
        "weight",
    ]
    assert read_edges_dir(spark, path, "p1", "p2", [""], keep_endpoints=False).columns == ["src", "dst"]


def test_number_endpoints_become_text(spark, tmp_path):
    path = edge_dir(tmp_path, "1,2\n10,1\n", "p1:Integer\np2:Integer\n")
    edges = read_edges_dir(spark, path, "p1", "p2")
    assert rows_of(edges, "src", "dst", "p1") == [("1", "2", 1), ("10", "1", 10)]


@pytest.mark.parametrize("data, kind", [("x,b\n", "int"), ("1.5,b\n", "int")])
def test_bad_number_raises(spark, tmp_path, data, kind):
    path = edge_dir(tmp_path, data, "p1:Integer\np2:String\n")
    with pytest.raises(Exception, match=f"column p1: not a {kind}"):
        read_rows_dir(spark, path).collect()


def test_unknown_sidecar_type(spark, tmp_path):
    path = edge_dir(tmp_path, "a,b\n", "p1:String\np2:Date\n")
    with pytest.raises(ValueError, match="p2"):
        read_schema(spark, path)


def test_sidecar_round_trip(spark, tmp_path):
    schema = T.StructType().add("a", "string").add("b", "integer").add("c", "double")
    write_schema(spark, str(tmp_path), schema)
    assert (tmp_path / "schema").read_text() == "a:String\nb:Integer\nc:Double\n"
    assert read_schema(spark, str(tmp_path)) == schema


def test_inferred_schema_names_three_types(spark):
    frame = spark.sql("SELECT 'x' AS s, 1 AS i, 1D AS d, 1L AS l, true AS b")
    assert [f.dataType.simpleString() for f in infer_schema(frame)] == ["string", "int", "double", "string", "string"]


def test_endpoint_property_keeps_orientation(spark):
    rows = spark.createDataFrame([("a", "b", 1)], "src string, dst string, n int")
    edges = graph_from_edges(project_edges(rows, "src", "dst", ["n"]), directed=False).edges
    assert rows_of(edges, "src", "dst", "src__prop", "dst__prop", "n") == [
        ("a", "b", "a", "b", 1),
        ("b", "a", "a", "b", 1),
    ]


def test_unknown_projection_column(spark):
    with pytest.raises(ValueError, match="nothing"):
        project_edges(spark.sql("SELECT 'a' AS x, 'b' AS y"), "x", "y", ["nothing"])


@pytest.fixture
def named(spark):
    rows = [(name, None if i == 0 else i / 3, i) for i, name in enumerate(NAMES)]
    values = spark.createDataFrame(rows, "id string, score double, n int")
    edges = values.select(F.col("id").alias("src"), F.col("id").alias("dst"))
    graph = graph_from_edges(edges, directed=True)
    return with_property(with_property(graph, values, "score"), values, "n"), rows


def test_vertices_csv(spark, tmp_path, named):
    graph, rows = named
    path = str(tmp_path / "out")
    result = write_vertices_csv(graph, path, ["score", "n"])
    assert result.number_of_lines == len(rows)
    parts = list((tmp_path / "out").glob("part-*"))
    assert result.file_size >= sum(p.stat().st_size for p in parts)
    back = (
        spark.read.option("header", True)
        .option("escape", '"')
        .schema("name string, score double, n int")
        .csv(path)
    )
    assert sorted((r["name"] or "", r["score"], r["n"]) for r in back.collect()) == sorted(rows)
    with pytest.raises(FileExistsError):
        write_vertices_csv(graph, path, ["score"], overwrite=False)
    assert write_vertices_csv(graph, path, ["n", "name"]).number_of_lines == len(rows)
    assert spark.read.option("header", True).csv(path).columns == ["n", "name"]


def test_vertices_dir(spark, tmp_path, named):
    graph, rows = named
    path = str(tmp_path / "out")
    result = write_vertices_dir(graph, path, ["n"])
    assert result.number_of_lines == len(rows)
    assert (tmp_path / "out" / "schema").read_text() == "name:String\nn:Integer\n"
    lines = sorted(r["value"] for r in spark.read.text(f"{path}/data.csv").collect())
    assert lines == sorted(
        '"' + name.replace('"', '""') + f'",{i}' for i, name in enumerate(NAMES)
    )
    assert rows_of(read_rows_dir(spark, path), "name", "n") == sorted((name, i) for i, name in enumerate(NAMES))


def test_missing_value_is_an_empty_field(spark, tmp_path, named):
    graph, _ = named
    write_vertices_dir(graph, str(tmp_path / "out"), ["score"])
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/out/data.csv").collect()]
    assert '"plain",' in lines


def test_unknown_vertex_property(tmp_path, named):
    with pytest.raises(ValueError, match="colour"):
        write_vertices_csv(named[0], str(tmp_path / "out"), ["colour"])


@pytest.mark.parametrize("row", ["c", "e,f,3,4"])
def test_rows_of_another_length_raise(spark, tmp_path, row):
    path = tmp_path / "edges.csv"
    path.write_text(f"src,dst,weight\na,b,2\n{row}\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        read_edges_csv(spark, str(path), "src", "dst", "weight").collect()


def test_rows_short_of_the_weight_and_empty_names(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text('src,dst,weight\na,b\nc,,2\n"",d,3\n')
    rows = read_edges_csv(spark, str(path), "src", "dst", "weight").collect()
    assert sorted(tuple(r) for r in rows) == [("", "d", 3.0), ("a", "b", 1.0), ("c", "", 2.0)]


def test_files_with_other_headers_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("src,dst,weight\na,b,1\n")
    (tmp_path / "b.csv").write_text("dst,src,weight\nc,d,1\n")
    with pytest.raises(Exception, match="header"):
        read_edges_csv(spark, str(tmp_path), "src", "dst", "weight").collect()


def test_export_reads_back_nulls_empty_texts_and_line_breaks(spark, make_graph, tmp_path):
    values = spark.createDataFrame([("a", None, None), ("b", "", 1.0), ("c", "x\ny", 2.0)], "id string, t string, n double")
    graph = make_graph([("a", "b"), ("b", "c")])
    for column in ("t", "n"):
        graph = with_property(graph, values, column)
    result = write_vertices_dir(graph, str(tmp_path / "out"), ["t", "n"])
    assert result.has_line_breaks and result.number_of_lines == 3
    rows = read_rows_dir(spark, str(tmp_path / "out"), multiline=True).collect()
    assert sorted(tuple(r) for r in rows) == [("a", None, None), ("b", "", 1.0), ("c", "x\ny", 2.0)]


def test_jobs_refuse_outputs_around_their_input(spark, tmp_path):
    source = tmp_path / "in" / "edges"
    source.mkdir(parents=True)
    for target in (source, tmp_path / "in", source / "deeper"):
        with pytest.raises(ValueError, match="output path"):
            refuse_same_path(spark, str(source), str(target))
    refuse_same_path(spark, str(source), str(tmp_path / "in" / "edges2"))


@pytest.mark.parametrize("line", ["1,a,b,2,surplus", "1,a"])
def test_wrong_rows_raise_where_the_first_column_is_not_asked_for(spark, tmp_path, line):
    path = tmp_path / "edges.csv"
    path.write_text(f"line,src,dst,weight\n0,a,b,1\n{line}\n")
    edges = read_edges_csv(spark, str(path), "src", "dst", "weight")
    for frame in (edges, edges.select("dst"), edges.groupBy().count()):
        with pytest.raises(Exception, match="wrong number of fields"):
            frame.collect()
    path.write_text("line,src,dst,weight\n0,a,b,1\n1,b,c\n")
    assert rows_of(read_edges_csv(spark, str(path), "src", "dst", "weight"), "src", "dst", "weight") == [("a", "b", 1.0), ("b", "c", 1.0)]


@pytest.mark.parametrize("line", ["2,a,b,4", "2,a"])
def test_wrong_rows_of_a_directory_raise_without_the_first_column(spark, tmp_path, line):
    path = edge_dir(tmp_path, f"1,a,b\n{line}\n", "n:Integer\np1:String\np2:String\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        read_edges_dir(spark, path, "p1", "p2", keep_endpoints=False).collect()


def cut_files(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def any_cut(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    yield lambda size: cut_files(spark, size)
    for k, v in before.items():
        spark.conf.set(k, v)


BREAKS = 'src,dst\n"a\n\n,""b""\n",c\n\nd,"""\n"\n"e",f\ng,"h\ni"\n'


def test_quoted_breaks_at_every_cut(spark, tmp_path, any_cut):
    path = tmp_path / "edges.csv"
    path.write_text(BREAKS)
    whole = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(path))
    expected = rows_of(whole, "src", "dst")
    assert ("a\n\n,\"b\"\n", "c") in expected and len(expected) == 4
    for size in [*range(1, 20), 27, 36, len(BREAKS)]:  # of 1 byte: a cut at every place
        any_cut(size)
        edges = read_edges_csv(spark, str(path), "src", "dst", multiline=True)
        assert rows_of(edges, "src", "dst") == expected, size


@pytest.mark.parametrize("size", [3, 17, 64, 100_000])
def test_quoted_breaks_in_several_files(spark, tmp_path, any_cut, size):
    """Records through many ranges, CRLF, many files, and one without a last line break."""
    rng = random.Random(size)
    rows = [("".join(rng.choices('ab,"\n\r ', k=rng.randint(1, 40))), f"n{i}") for i in range(60)]
    rows += [("long " * 40 + "\n" * 30, "n60"), ("\u00e9\U0001f600\n", "n61")]
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        text = [",".join('"' + c.replace('"', '""') + '"' for c in row) for row in rows[k::3]]
        (tmp_path / f"{k}.csv").write_bytes(end.join(["src,dst", *text]).encode() + (b"" if k == 2 else end.encode()))
    any_cut(size)
    edges = read_edges_csv(spark, str(tmp_path), "src", "dst", multiline=True)
    assert rows_of(edges, "src", "dst") == sorted(rows)


@pytest.mark.parametrize("text", ['a,"b\nc,d\n', 'a"x,b\nc,d"y\n', 'a,"b"c\n"\n'])
def test_quotes_that_are_not_those_of_whole_fields_raise(spark, tmp_path, text):
    path = tmp_path / "edges.csv"
    path.write_text("src,dst\n" + text)
    with pytest.raises(Exception, match="quotes are not closed or not around whole fields"):
        read_edges_csv(spark, str(path), "src", "dst", multiline=True).collect()


def test_multiline_checks_headers_and_lengths(spark, tmp_path):
    (tmp_path / "a.csv").write_text('src,dst,weight\n"a\n",b\n')
    edges = read_edges_csv(spark, str(tmp_path), "src", "dst", "weight", multiline=True)
    assert rows_of(edges, "src", "dst", "weight") == [("a\n", "b", 1.0)]
    (tmp_path / "b.csv").write_text("src,dst,weight\na,b,1,2\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        read_edges_csv(spark, str(tmp_path), "src", "dst", multiline=True).collect()
    (tmp_path / "b.csv").write_text("dst,src,weight\na,b,1\n")
    with pytest.raises(Exception, match="header is not src,dst,weight"):
        read_edges_csv(spark, str(tmp_path), "src", "dst", multiline=True).collect()
    path = edge_dir(tmp_path, '1,"a\nb",""\n2,,c\n', "n:Integer\np1:String\np2:String\n")
    assert [tuple(r) for r in read_rows_dir(spark, path, multiline=True).orderBy("n").collect()] == [(1, "a\nb", ""), (2, None, "c")]


def test_records_are_shuffled_without_their_paths(spark, tmp_path):
    """Text moves once, by the number of its range; records within a range are put together where they are."""
    from vertexloom.sources.csv_records import read_records

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0").write_text('a,"b\n""c""\n",d\ne,f,g\n')
    records = read_records(spark, str(tmp_path / "in"))
    assert sorted(row["record"] for row in records.collect()) == ['a,"b\n""c""\n",d', "e,f,g"]
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    moved = [line for line in records._jdf.queryExecution().sparkPlan().toString().splitlines() if "Window" in line]
    assert moved and not any("file#" in line for line in moved if "odd#" in line and "all_odd" not in line)
    assert "by#" in plan
