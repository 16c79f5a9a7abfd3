"""Centroid clustering against plain Python."""

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from vertexloom.llm.centroids import Bisectors, clustered, whole_numbers


def plain(rows, k, rounds, scale, dims):
    kept = [(i, [int(np.floor(scale * float(np.float64(x)))) for x in v]) for i, v in rows if v is not None and len(v) == dims]
    order = sorted(kept, key=lambda r: sha256(f"2:{r[0]}".encode()).hexdigest())
    centroids = [list(v) for _, v in order[:k]]

    def far(v, c):
        return sum((a - b) ** 2 for a, b in zip(v, c, strict=True))

    def nearest(v):
        return min(range(len(centroids)), key=lambda j: (far(v, centroids[j]), j))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    placed = [(i, nearest(v), far(v, centroids[nearest(v)])) for i, v in kept]
    sums = {j: sum(d for _, c, d in placed if c == j) for j in range(k)}
    return sorted(
        (i, c, d, sums[c], sum(sums.values()), sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for i, c, d in placed
    )


def rows_of(frame):
    found = frame.select(F.col("row.vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(r) for r in found.collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("spread", [1.0, 1e-2, 3e5])
def test_as_in_plain_python(spark, spread):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, spread, 6) + rng.integers(0, 4) * spread).tolist()) for i in range(150)]
    found = clustered(vectors(spark, rows).repartition(5), clusters=7, rounds=3, dimensions=6)
    assert rows_of(found) == plain(rows, 7, 3, 256, 6)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)]  # three distinct vectors, nine centroids
    assert rows_of(clustered(vectors(spark, rows), clusters=9, rounds=4, dimensions=2)) == plain(rows, 9, 4, 256, 2)
    middle = Bisectors(np.array([[4, 0], [0, 0], [2, 2], [0, 0]])).nearest(np.array([[2, 0], [0, 0], [2, 1]]))
    assert middle[0].tolist() == [0, 1, 2] and middle[1].tolist() == [4, 0, 1]


def test_very_large_components_stay_exact(spark):
    rows = [(i, [3e5 * (i % 5) + i, -1e4 * i]) for i in range(40)]
    assert whole_numbers(np.array([[3e6, 1.0]])).dtype == object
    assert rows_of(clustered(vectors(spark, rows), clusters=4, rounds=3, dimensions=2)) == plain(rows, 4, 3, 256, 2)
    with pytest.raises(Exception, match="does not fit a long"):
        clustered(vectors(spark, [(1, [1e12, 0.0]), (2, [-1e12, 0.0])]), clusters=1, dimensions=2).collect()


def test_rows_that_take_no_part_repeats_and_clashing_columns(spark):
    good = [(i, [i / 7, -i / 3]) for i in range(20)]
    bad = [(90, None), (91, [1.0]), (92, [1.0, None]), (93, [float("nan"), 1.0]), (94, [float("inf"), 1.0]), (95, [])]
    frame = vectors(spark, good + bad).selectExpr("*", "1 AS cluster", "'x' AS row", "2 AS distance", "vec_id AS h")
    assert rows_of(clustered(frame, clusters=3, dimensions=2)) == plain(good, 3, 5, 256, 2)
    twice = [*good, *good, (None, [0.5, 0.5])]
    found = clustered(vectors(spark, twice), clusters=3, dimensions=2)
    assert found.count() == 41 and found.where("row.vec_id IS NULL").count() == 1
    assert found.groupBy("row.vec_id").agg(F.count_distinct("cluster").alias("n")).where("n > 1").count() == 0


def test_few_or_no_vectors(spark):
    one = rows_of(clustered(vectors(spark, [(5, [1.0, 2.0])]), dimensions=2))
    assert [r[:5] for r in one] == [(5, 0, 0, 0, 0)]
    none = clustered(vectors(spark, []), dimensions=2)
    assert none.count() == 0 and "centroid_sha256" in none.columns
