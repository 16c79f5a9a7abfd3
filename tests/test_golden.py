"""PageRank and clustering against hand-checked results on tiny graphs."""

import pytest

from vertexloom.operators import pagerank, peer_pressure

A1 = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "a"), ("a", "c")]
A2 = [("a", "b"), ("c", "d")]
A3 = [("v1", "v2"), ("v2", "v3"), ("v3", "v1"), ("v3", "v4")]


def as_dict(graph, column):
    return {row["id"]: row[column] for row in graph.vertices.collect()}


@pytest.mark.parametrize(
    "pairs, directed, expected",
    [
        (A1, True, {"a": 0.21456022, "b": 0.12129105, "c": 0.22480026, "d": 0.22149204, "e": 0.21785642}),
        (A1, False, {"a": 0.24369645, "b": 0.16809466, "c": 0.24369645, "d": 0.17225622, "e": 0.17225622}),
        (A2, True, {"a": 0.1754386, "b": 0.3245614, "c": 0.1754386, "d": 0.3245614}),
        (A3, True, {"v1": 0.21375212, "v2": 0.26461796, "v3": 0.30787781, "v4": 0.21375212}),
    ],
)
def test_pagerank(make_graph, pairs, directed, expected):
    result = pagerank(make_graph(pairs, directed), "rank")
    ranks = as_dict(result.graph, "rank")
    assert {v: round(r, 8) for v, r in ranks.items()} == expected
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-9)
    assert result.iterations == 20


def clusters(*groups):
    return {v: name for name, members in groups for v in members}


@pytest.mark.parametrize(
    "pairs, directed, vote, expected, iterations",
    [
        (A1, True, "unit", clusters(("a", "abcde")), 4),
        (A1, True, "distributed", clusters(("b", "abcde")), 5),
        (A1, False, "unit", clusters(("a", "abcde")), 3),
        (A1, False, "distributed", clusters(("b", "abc"), ("d", "de")), 2),
        (A2, True, "unit", clusters(("a", "ab"), ("c", "cd")), 2),
        (A2, True, "distributed", clusters(("a", "ab"), ("c", "cd")), 2),
        (A2, False, "unit", clusters(("a", "ab"), ("c", "cd")), 2),
        (A3, True, "unit", clusters(("v1", ["v1", "v2", "v3", "v4"])), 4),
        (A3, True, "distributed", clusters(("v1", ["v1", "v2", "v3", "v4"])), 4),
        (A3, False, "distributed", clusters(("v1", ["v1", "v2"]), ("v4", ["v3", "v4"])), 2),
    ],
)
def test_peer_pressure(make_graph, pairs, directed, vote, expected, iterations):
    result = peer_pressure(make_graph(pairs, directed), "c", vote=vote)
    assert as_dict(result.graph, "c") == expected
    assert (result.iterations, result.converged) == (iterations, True)
    assert result.number_of_clusters == len(set(expected.values()))


def test_top_vertices(make_graph):
    result = pagerank(make_graph(A1), "rank", 3)
    assert [row["name"] for row in result.top.collect()] == ["c", "d", "e"]
