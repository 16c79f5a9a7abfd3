"""The iterative operators against plain Python on random graphs."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from vertexloom.operators import pagerank, peer_pressure


def random_pairs(seed, size=12, edges=40):
    """Parallel edges, self-loops, sinks, and one vertex with a third of the out-edges."""
    rng = random.Random(seed)
    names = [f"v{i}" for i in range(size)]
    hub = names[0]
    pairs = [(hub if rng.random() < 0.33 else rng.choice(names[: size - 2]), rng.choice(names)) for _ in range(edges)]
    return pairs + [(names[1], names[1]), pairs[0], pairs[0]]


def python_pagerank(pairs, iterations, alpha=0.85):
    vertices = {v for pair in pairs for v in pair}
    out = Counter(src for src, _ in pairs)
    rank = dict.fromkeys(vertices, 1 / len(vertices))
    for _ in range(iterations):
        sinks = sum(r for v, r in rank.items() if not out[v])
        inflow = defaultdict(float)
        for src, dst in pairs:
            inflow[dst] += rank[src] / out[src]
        rank = {v: (1 - alpha + alpha * sinks) / len(vertices) + alpha * inflow[v] for v in vertices}
    return rank


def python_peer_pressure(pairs, vote, rounds):
    vertices = {v for pair in pairs for v in pair}
    out = Counter(src for src, _ in pairs)

    def strength(v):
        return Fraction(1) if vote == "unit" else Fraction(1, out[v]) if out[v] else Fraction(0)

    cluster = {v: v for v in vertices}
    for k in range(rounds):
        votes = defaultdict(lambda: defaultdict(Fraction))
        for src, dst in [*pairs, *((v, v) for v in vertices)]:
            votes[dst][cluster[src]] += strength(src)
        after = {v: min(votes[v], key=lambda c: (-votes[v][c], c)) for v in vertices}
        if after == cluster:
            return cluster, k + 1, True
        cluster = after
    return cluster, rounds, False


@pytest.mark.parametrize("seed, edges_per_hub", [(1, 1_000_000), (2, 5)])
def test_pagerank(make_graph, seed, edges_per_hub):
    pairs = random_pairs(seed)
    result = pagerank(make_graph(pairs), "r", max_iter=6, edges_per_hub=edges_per_hub)
    ranks = {row["id"]: row["r"] for row in result.graph.vertices.collect()}
    assert ranks == pytest.approx(python_pagerank(pairs, 6), abs=1e-12)
    assert sum(ranks.values()) == pytest.approx(1.0, abs=1e-9)


@pytest.mark.parametrize("vote", ["unit", "distributed"])
@pytest.mark.parametrize("seed, edges_per_hub", [(3, 1_000_000), (4, 5), (5, 1)])
def test_peer_pressure(make_graph, vote, seed, edges_per_hub):
    pairs = random_pairs(seed)
    result = peer_pressure(make_graph(pairs), "c", vote=vote, max_iter=4, edges_per_hub=edges_per_hub)
    found = {row["id"]: row["c"] for row in result.graph.vertices.collect()}
    assert (found, result.iterations, result.converged) == python_peer_pressure(pairs, vote, 4)


def test_order_and_partitioning_do_not_matter(make_graph):
    graph = make_graph(random_pairs(6))
    shuffled = graph.with_edges(graph.edges.orderBy(F.rand(1)).repartition(7))
    answers = [
        {row["id"]: row["c"] for row in peer_pressure(g, "c", vote="distributed", max_iter=3).graph.vertices.collect()}
        for g in (graph, shuffled)
    ]
    assert answers[0] == answers[1]


def test_tolerance_stops_early_and_mass_scales(make_graph):
    result = pagerank(make_graph([("a", "b"), ("b", "a")]), "r", tol=1e-6, total_mass=2.0)
    assert result.iterations == 1
    assert [row["r"] for row in result.graph.vertices.collect()] == pytest.approx([1.0, 1.0])


def test_no_iterations_and_no_vertices(make_graph):
    assert pagerank(make_graph([("a", "b")]), "r", max_iter=0).graph.vertices.first()["r"] == 0.5
    empty = pagerank(make_graph([]), "r", max_iter=2)
    assert empty.graph.vertices.count() == 0
    assert peer_pressure(make_graph([]), "c").number_of_clusters == 0


def test_two_sides_can_swap_for_ever(make_graph):
    pairs = [("a", "x"), ("a", "x"), ("x", "a"), ("x", "a")]
    result = peer_pressure(make_graph(pairs), "c", max_iter=3)
    assert (result.iterations, result.converged) == (3, False)


def test_isolated_vertices_keep_their_cluster(spark, make_graph):
    from vertexloom.operators import add_vertices

    graph = add_vertices(make_graph([("a", "b")]), spark.createDataFrame([("z",)], "id string"))
    for vote in ("unit", "distributed"):
        found = {r["id"]: r["c"] for r in peer_pressure(graph, "c", vote=vote).graph.vertices.collect()}
        assert found == {"a": "a", "b": "a", "z": "z"}


def test_unknown_vote(make_graph):
    with pytest.raises(ValueError, match="loud"):
        peer_pressure(make_graph([("a", "b")]), vote="loud")
