"""Centroid clustering by a bisector tournament, in whole numbers throughout.

Between two centroids lies a bisecting plane. Its integer normal and threshold are worked
out once a round for every pair; the sign of one linear form then tells which of the two
is nearer to a vector, and zero favours the smaller number. A vector starts with centroid
0 and meets the others one after the other: k - 1 signs leave the nearest, and only to it
a distance is worked out. Tasks add up the vectors of each cluster, so what a round
shuffles is one row per cluster and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vertexloom.llm.common import small_batches

CLUSTERS, ROUNDS, SCALE, DIMENSIONS, SEED = 40, 5, 256, 64, "2"
#: Numbers below this leave products and sums of up to 64 terms within 64 bits.
SMALL = 1 << 26
LONGEST = (1 << 63) - 1


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles; Python's integers where 64 bits might not do for what follows."""
    floors = np.floor(float(scale) * np.asarray(vectors, np.float64))
    if not np.isfinite(floors).all():
        raise OverflowError("a component is too large for a double once scaled")
    if np.abs(floors).max(initial=0) < SMALL:
        return floors.astype(np.int64)
    return np.array([[int(x) for x in row] for row in floors], object).reshape(floors.shape)


def as_array(rows: list[list[int]], dimensions: int = DIMENSIONS) -> np.ndarray:
    small = all(abs(x) < SMALL for row in rows for x in row)
    return np.array(rows, np.int64 if small else object).reshape(len(rows), dimensions)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = (centroids * centroids).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smaller one at ties, and the squared distance to it."""
        wide = vectors.dtype == object or self.centroids.dtype == object
        vectors = vectors.astype(object) if wide else vectors
        left = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            normal = self.normals[left, rival]
            form = (vectors * normal).sum(axis=1) if wide else np.einsum("nd,nd->n", vectors, normal)
            beaten = (form - self.thresholds[left, rival] > 0).astype(bool)
            left[beaten] = rival
        apart = vectors - self.centroids[left]
        return left, (apart * apart).sum(axis=1)


def usable(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Rows whose ``embedding`` has exactly ``dimensions`` components, all of them finite."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.where((F.size("embedding") == dimensions) & F.col("embedding").isNotNull()).where(~bad)


def first_centroids(kept: DataFrame, clusters: int, scale: int, seed: str) -> list[list[int]]:
    """Vectors of the ``clusters`` rows with the smallest sha256 of ``seed:vec_id``, in that order.

    A thin pass picks them by hash; only those few vectors are fetched then.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    marked = kept.select(F.sha2(name.cast("binary"), 256).alias("h"), F.xxhash64("embedding").alias("e"), "embedding")
    picked = [(r["h"], r["e"]) for r in marked.select("h", "e").orderBy("h", "e").limit(clusters).collect()]
    wanted = F.col("h").isin([h for h, _ in picked]) & F.col("e").isin([e for _, e in picked])
    found = marked.where(wanted).groupBy("h", "e").agg(F.first("embedding").alias("embedding")).collect() if picked else []
    by_mark = {(r["h"], r["e"]): r["embedding"] for r in found}
    return [[int(x) for x in whole_numbers(np.array([by_mark[mark]]), scale)[0]] for mark in picked]


def _matrix(embeddings: pd.Series, dimensions: int) -> np.ndarray:
    return np.stack([np.asarray(e, np.float64) for e in embeddings]) if len(embeddings) else np.zeros((0, dimensions))


def _totals(centroids: list[list[int]], scale: int, dimensions: int):
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bisectors, k = Bisectors(as_array(centroids, dimensions)), len(centroids)
        counts, far = [0] * k, [0] * k
        sums = np.zeros((k, dimensions), object)
        for batch in batches:
            vectors = whole_numbers(_matrix(batch["embedding"], dimensions), scale)
            nearest, distances = bisectors.nearest(vectors)
            wide = float(distances.max(initial=0)) * len(distances) > LONGEST // 2
            for cluster in np.unique(nearest):
                mine = nearest == cluster
                counts[cluster] += int(mine.sum())
                far[cluster] += int(distances[mine].astype(object if wide else np.int64).sum())
                sums[cluster] += vectors[mine].sum(axis=0).astype(object)
        rows = {"cluster": range(k), "n": counts, "far": [Decimal(x) for x in far]}
        rows |= {f"s{i}": [Decimal(int(x)) for x in sums[:, i]] for i in range(dimensions)}
        out = pd.DataFrame(rows)
        yield out[out["n"] > 0]

    return add_up


def totals(kept: DataFrame, centroids: list[list[int]], scale: int = SCALE, dimensions: int = DIMENSIONS) -> list:
    """For each cluster with vectors: their number, the sum of their distances, and of their components."""
    parts = [f"s{i}" for i in range(dimensions)]
    schema = "cluster int, n long, far decimal(38,0), " + ", ".join(f"{p} decimal(38,0)" for p in parts)
    each = kept.select("embedding").mapInPandas(_totals(centroids, scale, dimensions), schema)
    return each.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("far").alias("far"), *[F.sum(p).alias(p) for p in parts]).collect()


def _assigned(centroids: list[list[int]], scale: int, dimensions: int):
    @F.pandas_udf(T.StructType().add("cluster", T.IntegerType()).add("distance", T.LongType()))
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bisectors = Bisectors(as_array(centroids, dimensions))
        for embeddings in batches:
            nearest, distances = bisectors.nearest(whole_numbers(_matrix(embeddings, dimensions), scale))
            if distances.dtype == object and max(distances, default=0) > LONGEST:
                raise OverflowError("a squared distance does not fit a long")
            yield pd.DataFrame({"cluster": nearest.astype(np.int32), "distance": distances.astype(np.int64)})

    return assign


def centroids_of(
    kept: DataFrame, clusters: int, rounds: int, scale: int = SCALE, dimensions: int = DIMENSIONS, seed: str = SEED
) -> list[list[int]]:
    """The centroids after ``rounds`` rounds over rows that :func:`usable` keeps."""
    centroids = first_centroids(kept, clusters, scale, seed)
    for _ in range(rounds if centroids else 0):
        moved = list(centroids)
        for row in totals(kept, centroids, scale, dimensions):
            moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dimensions)]
        if moved == centroids:  # every further round would end the same
            break
        centroids = moved
    return centroids


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    seed: str = SEED,
) -> DataFrame:
    """``row``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of the vectors that take part.

    ``vectors`` has ``vec_id`` and ``embedding``. Vectors that are null, of another length
    than ``dimensions``, or hold null or non-finite components take no part. Components
    count as floor(scale * x), and all that follows is exact. With fewer vectors than
    ``clusters``, each is a centroid; an empty table gives no rows. A null id counts as an
    empty text in the hash that orders the first centroids; rows with one id go by a hash
    of their vectors, and equal rows may all be first centroids, of which all but the
    first stay empty and where they are. A distance or a sum of distances that does not
    fit a long raises. Extra columns travel inside ``row``.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kept = usable(vectors, dimensions)
    centroids = centroids_of(kept, clusters, rounds, scale, dimensions, seed)
    ends = {r["cluster"]: int(r["far"]) for r in totals(kept, centroids, scale, dimensions)} if centroids else {}
    if sum(ends.values()) > LONGEST:
        raise OverflowError("the sum of all distances does not fit a long")
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # one row per cluster
    facts = spark.createDataFrame(
        [(i, ends.get(i, 0), sum(ends.values()), d) for i, d in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    found = kept.select(F.struct("*").alias("row"), _assigned(centroids, scale, dimensions)("embedding").alias("found"))
    placed = found.select("row", F.col("found.cluster").alias("cluster"), F.col("found.distance").alias("distance"))
    return placed.join(F.broadcast(facts), "cluster").select(
        "row", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
