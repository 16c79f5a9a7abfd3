"""PageRank by power iteration (Page, Brin, Motwani and Winograd, 1999)."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vertexloom.graph import Graph
from vertexloom.operators.construct import with_property
from vertexloom.operators.propagation import EDGES_PER_HUB, laid_out
from vertexloom.operators.select import top_vertices
from vertexloom.runtime import MAX_PARTITIONS, checkpoint, drop_checkpoint


@dataclass(frozen=True)
class PageRankResult:
    graph: Graph
    elapsed_ms: int
    iterations: int
    top: DataFrame | None


def pagerank(
    graph: Graph,
    result: str = "pagerank",
    return_top: int = 0,
    *,
    alpha: float = 0.85,
    max_iter: int = 20,
    tol: float | None = None,
    total_mass: float = 1.0,
    edges_per_hub: int = EDGES_PER_HUB,
    max_partitions: int = MAX_PARTITIONS,
) -> PageRankResult:
    """Rank the vertices and store the rank as a vertex property.

    Parallel edges count separately, edge weights do not matter, and the rank
    of vertices without out-edges is shared by all. Ranks start equal and add
    up to ``total_mass``. Stops after ``max_iter`` iterations, or earlier once
    the ranks (of mass 1) move by less than ``tol`` in total. ``max_partitions`` bounds
    the width of the iterations.
    """
    started = time.monotonic()
    share = F.col("copies") / F.col("out_degree")
    with laid_out(graph, share, edges_per_hub=edges_per_hub, max_partitions=max_partitions) as layout:
        n = max(layout.num_vertices, 1)
        sink_mass = layout.num_sinks / n
        state = layout.vertices.select(
            "key", F.lit(1.0 / n).alias("rank"), (F.col("out_degree") == 0).alias("is_sink"), "is_hub"
        )
        inflow = F.sum(F.col("rank") * F.col("weight")).alias("received")
        measures = [
            F.coalesce(F.sum(F.when(F.col("is_sink"), F.col("rank"))), F.lit(0.0)).alias("sink_mass"),
            F.coalesce(F.sum(F.abs(F.col("rank") - F.col("before"))), F.lit(0.0)).alias("change"),
        ]
        iterations = 0
        while iterations < max_iter:
            received = layout.send(state, "rank").groupBy("dst").agg(inflow)
            base = (1.0 - alpha + alpha * sink_mass) / n
            moved = state.join(received, state.key == received.dst, "left").selectExpr(
                "key",
                f"{base!r}D + {alpha!r}D * coalesce(received, 0D) AS rank",
                "rank AS before",
                "is_sink",
                "is_hub",
            )
            # the job that writes the state also measures it
            seen = Observation()
            latest = checkpoint(moved.observe(seen, *measures).drop("before"))
            if iterations:
                drop_checkpoint(state)
            state = latest
            sink_mass = seen.get["sink_mass"]
            iterations += 1
            if tol is not None and seen.get["change"] < tol:
                break
        ranks = checkpoint(
            layout.vertices.join(state, "key").select(
                "id", (F.col("rank") * F.lit(float(total_mass))).alias(result)
            )
        )
        if iterations:
            drop_checkpoint(state)
    ranked = with_property(graph, ranks, result, unique=True)
    elapsed_ms = int((time.monotonic() - started) * 1000)
    top = top_vertices(ranked, result, return_top) if return_top > 0 else None
    return PageRankResult(ranked, elapsed_ms, iterations, top)
