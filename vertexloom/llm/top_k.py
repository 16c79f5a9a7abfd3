"""Exact search for the largest inner products, with buckets of vectors of like length.

Vectors are sorted by length and packed into buckets. No vector of a bucket can score
above the query's length times the bucket's largest, so whole buckets fall away against
the score that is k-th best so far. In a bucket that stays, that score over both lengths
is a threshold on the cosine. Where it is high, vectors fall away whose coordinates lie
outside the range that the query's largest coordinates leave; where it is low, those that
are too short do. What is left is multiplied out. First thresholds come from a bounded
number of buckets; they only prune and never decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vertexloom.llm.common import small_batches, stored

K = 10
BUCKET, QUERY_BLOCK = 512, 256
FIRST_BUCKETS = 16
BUCKETS_PER_GROUP = 16
HIGH_COSINE, FOCUS = 0.5, 3
PACKED = "id long, dim int, longest double, shortest double, ids binary, vectors binary"


def whole_numbers(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``v`` (whole numbers), ``dim`` and ``length`` of the vectors that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    known = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    whole = known.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding"), scale).alias("v"))
    return whole.select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("length"))


def _pack(size: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        kept = None

        def bucket(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            number += 1
            matrix = np.array(rows["v"].tolist(), np.int64).reshape(len(rows), -1)
            return pd.DataFrame(
                {
                    "id": [(task << 32) + number],
                    "dim": [matrix.shape[1]],
                    "longest": [rows["length"].max()],
                    "shortest": [rows["length"].min()],
                    "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
                    "vectors": [matrix.tobytes()],
                }
            )

        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            while len(rows):
                same = int((rows["dim"] == rows["dim"].iloc[0]).to_numpy().cumprod().sum())
                if same < size and same == len(rows):
                    break
                yield bucket(rows.iloc[: min(size, same)])
                rows = rows.iloc[min(size, same) :]
            kept = rows
        if kept is not None and len(kept):
            yield bucket(kept)

    return pack


def packed(vectors: DataFrame, size: int, what: str) -> DataFrame:
    """Buckets of up to ``size`` vectors of one dimension and of like length."""
    order = ["dim", F.col("length").desc(), "vec_id"]
    return stored(vectors.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_pack(size), PACKED), what)


class Block:
    """Vectors of a packed row, in numbers whose products are exact."""

    def __init__(self, dim: int, ids: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        whole = np.frombuffer(vectors, np.int64).reshape(len(self.ids), dim)
        self.largest = float(np.abs(whole).max(initial=0))
        self.whole, self.real = whole, whole.astype(np.float64)
        self.lengths = np.sqrt((self.real**2).sum(axis=1))

    def products(self, other: Block, mine, others) -> np.ndarray:
        exact = self.largest * other.largest * max(1, self.whole.shape[1]) < 2**53
        if exact:
            return (self.real[mine] @ other.real[others].T).astype(np.int64)
        return self.whole[mine] @ other.whole[others].T


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _survivors(query: np.ndarray, length: float, bucket: Block, threshold: float) -> np.ndarray | None:
    """Positions that may reach the threshold; None for all. Bounds give way a little to rounding."""
    if threshold <= 0:
        return None
    longest = bucket.lengths.max()
    if length * longest < threshold * (1 - 1e-9):
        return np.zeros(0, np.int64)
    cosine = threshold / (length * longest) * (1 - 1e-9)
    able = bucket.lengths >= threshold / length * (1 - 1e-9)
    if cosine >= HIGH_COSINE:
        unit = query / length
        for c in np.argsort(-np.abs(unit))[:FOCUS]:
            at = unit[c] * cosine
            reach = np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[c] ** 2)))
            coordinate = bucket.real[:, c] / np.maximum(bucket.lengths, 1e-300)
            # Beyond these angles the range ends at the pole, where nothing falls away.
            if unit[c] > -cosine:
                able &= coordinate >= at - reach - 1e-9
            if unit[c] < cosine:
                able &= coordinate <= at + reach + 1e-9
    return np.flatnonzero(able)


def _thresholds(first: list[tuple], k: int):
    def lowest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = [Block(*row) for row in first]
        for batch in batches:
            bounds, needs = [], []
            for row in batch.itertuples(index=False):
                queries = Block(row.dim, row.ids, row.vectors)
                near = [b for b in blocks if b.whole.shape[1] == row.dim]
                bound = np.full(len(queries.ids), -np.inf)
                if near:
                    ids = np.concatenate([b.ids for b in near])
                    scores = np.hstack([queries.products(b, slice(None), slice(None)) for b in near]).astype(np.float64)
                    scores[queries.ids[:, None] == ids[None, :]] = -np.inf
                    if scores.shape[1] >= k:
                        bound = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
                need = np.where(bound > 0, bound / np.maximum(queries.lengths, 1e-300), -np.inf)
                bounds.append(bound.tobytes())
                needs.append(float(need.min()) * (1 - 1e-9))
            yield batch.assign(bounds=bounds, need=needs)

    return lowest


def _searched(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                queries, bucket = Block(row.dim, row.q_ids, row.q_vectors), Block(row.dim, row.ids, row.vectors)
                bounds = np.frombuffer(row.bounds, np.float64)
                picked = [
                    _survivors(q, n, bucket, t) for q, n, t in zip(queries.real, queries.lengths, bounds, strict=True)
                ]
                whole = [i for i, p in enumerate(picked) if p is None or 2 * len(p) > len(bucket.ids)]
                products = dict(zip(whole, queries.products(bucket, whole, slice(None)), strict=True)) if whole else {}
                out = []
                for i, places in enumerate(picked):
                    if i in products:
                        ids, scores = bucket.ids, products[i]
                    elif len(places):
                        ids, scores = bucket.ids[places], queries.products(bucket, [i], places)[0]
                    else:
                        continue
                    fit = (ids != queries.ids[i]) & (scores >= bounds[i])
                    ids, scores = ids[fit], scores[fit]
                    best = _best(ids, scores, k)
                    out.append(
                        pd.DataFrame(
                            {"block": row.q_id, "place": i, "query_id": queries.ids[i], "vec_id": ids[best], "score": scores[best]}
                        )
                    )
                if out:
                    yield pd.concat(out, ignore_index=True)

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = 1024) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` best vectors of each query.

    Both inputs have ``vec_id`` and ``embedding``; components count as floor(scale * x).
    Scores are inner products of these whole numbers, ties go to the smaller id. Rows with
    the query's own id are not its results. Rows without an id, and vectors that are null
    or hold null or non-finite components, take no part; vectors of different dimensions
    do not meet. A query row that stands several times gets as many lists.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    buckets = packed(usable(vectors, scale), BUCKET, "buckets")
    blocks = packed(usable(queries, scale), QUERY_BLOCK, "queries")
    half = FIRST_BUCKETS // 2
    longest = buckets.orderBy(F.col("longest").desc(), "id").limit(half)
    spread = buckets.orderBy(F.xxhash64("id"), "id").limit(half)
    first = {r["id"]: (r["dim"], bytes(r["ids"]), bytes(r["vectors"])) for r in longest.unionByName(spread).collect()}
    bounded = stored(blocks.mapInPandas(_thresholds(list(first.values()), k), f"{PACKED}, bounds binary, need double"), "bounds")

    # A block of queries goes to every group of buckets, and there only to buckets long enough.
    groups = max(1, buckets.count() // BUCKETS_PER_GROUP)
    asked = bounded.select(
        F.col("id").alias("q_id"),
        "dim",
        F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"),
        "bounds",
        "need",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    held = buckets.select("dim", "ids", "vectors", "longest", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"))
    met = asked.join(held, ["group", "dim"]).where(F.col("longest") >= F.col("need")).drop("group", "longest", "need")
    found = met.mapInPandas(_searched(k), "block long, place int, query_id long, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
