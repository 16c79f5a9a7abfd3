"""Mixing sources to target weights by a Pfair schedule.

Time runs in slots; each slot carries one block of documents of one source. Block k of
a source with weight w may start at slot floor((k-1)/w) and must be done by ceil(k/w).
Earliest deadline first keeps every source within one block of its target share at every
slot. Weights are whole numbers n out of N, so the schedule repeats after N slots: the
slots of one period are worked out once, and the place of every block follows by
arithmetic, without a pass over the blocks. When a source is used up, the others go on
with their weights scaled up: a new phase with a schedule of its own.

There may be any number of sources. Beyond a number of them, the ones of least weight form
pools, each of which is one source of the schedule with the sum of its members' weights.
Members of a pool have weights, and documents for each unit of weight, within a factor of
two of each other, so they are used up at about the same time. Within its pool, document
k of a source with weight w stands at the time (k-u)/w, u being a fixed fraction of the
source; documents in the order of their times keep every member within four documents of its
share of the pool, until the first member is used up.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vertexloom.llm.common import stored

RESOLUTION = 1_000
BLOCK_DOCS = 8
ROWS_PER_BUCKET = 4_000
BROADCAST_SLOTS = 200_000
#: Largest sources that stand for themselves where weights follow from the sizes and there are more.
SINGLE_SOURCES = 64
SLOTS_OF_SMALLEST = 8
#: Roots are whole numbers of so many parts, so that their sums do not depend on the order.
ROOT_PARTS = 10**6


def period(weights: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of one period, by source: earliest deadline first among the released blocks."""
    total = sum(weights.values())
    waiting = [(0, -(-total // n), source, 1) for source, n in weights.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {source: [] for source in weights}
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, deadline, source, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, source, k))
        _, source, k = heapq.heappop(ready)
        slots[source].append(slot)
        if k < weights[source]:
            release, deadline = k * total // weights[source], -(-(k + 1) * total // weights[source])
            heapq.heappush(waiting, (release, deadline, source, k + 1))
    return slots


def phases(weights: Mapping[str, int], docs: Mapping[str, int], block_docs: int) -> list[dict]:
    """Stretches with the same sources: first block of each, slots of a period, place of the first document."""
    blocks = {s: -(-docs[s] // block_docs) for s in weights if docs.get(s)}
    used = dict.fromkeys(blocks, 0)
    place, found = 0, []
    while active := {s: weights[s] for s in blocks if used[s] < blocks[s]}:
        slots, total = period(active), sum(active.values())
        last = {
            s: (blocks[s] - used[s] - 1) // n * total + slots[s][(blocks[s] - used[s] - 1) % n]
            for s, n in active.items()
        }
        length = min(last.values()) + 1
        taken = {
            s: length // total * n + sum(slot < length % total for slot in slots[s]) for s, n in active.items()
        }
        begun = {s: used[s] for s in active}
        found.append(
            {"weights": active, "total": total, "slots": slots, "from": begun, "taken": taken, "place": place}
        )
        for s, n in taken.items():
            used[s] += n
            place += min(n * block_docs, docs[s] - (used[s] - n) * block_docs)
    return found


def tempered_weights(docs: Mapping[str, int], resolution: int = RESOLUTION) -> dict[str, int]:
    """Weights by the square root of a source's size: large sources below, small ones above their share."""
    return _whole({s: math.isqrt(n * ROOT_PARTS**2) for s, n in docs.items() if n}, resolution)


def _whole(roots: Mapping[str, int], resolution: int) -> dict[str, int]:
    """Weights in the ratio of ``roots``; the period is so long that the smallest has some slots, as
    far as the slots of all phases can be broadcast."""
    if not roots:
        return {}
    total = sum(roots.values())
    fine = -(-SLOTS_OF_SMALLEST * total // min(roots.values()))
    slots = max(resolution, min(fine, BROADCAST_SLOTS // len(roots)))
    return {s: max(1, (2 * slots * r + total) // (2 * total)) for s, r in roots.items()}


def mix(
    docs: DataFrame,
    weights: Mapping[str, int] | None = None,
    *,
    block_docs: int = BLOCK_DOCS,
    resolution: int = RESOLUTION,
    in_order: bool = False,
) -> DataFrame:
    """``docs`` with ``mix_position`` (from 0), ``mix_phase``, ``mix_slot`` and ``mix_block`` (from 1).

    Every row gets a place; nothing is repeated or left out. ``weights`` gives whole
    numbers by source; without it they follow from the sizes (``tempered_weights``), in a
    period of at least ``resolution`` slots. Rows whose source has no weight form one more
    source of weight 1, and so do rows without a source. Within a source, rows stand in the
    order of a hash of id and text, and equal rows in any order. Where more than
    ``resolution`` weights are given, or there are more than ``SINGLE_SOURCES`` sources
    without given weights, the sources of least weight form pools; ``mix_block`` then counts
    the blocks of the pool. Columns named like the four new ones are replaced.
    ``in_order`` also writes the rows out in the order of ``mix_position``.
    """
    spark = docs.sparkSession
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    name = source
    most = SINGLE_SOURCES
    if weights is not None:
        if any(int(n) != n or n < 1 for n in weights.values()):
            raise ValueError("weights are whole numbers of at least 1")
        weights, most = {"": 1, **weights}, resolution + 1
        name = F.when(source.isin(list(weights)), source).otherwise("")
    row = docs.drop("mix_position", "mix_phase", "mix_slot", "mix_block")
    by_source = docs.groupBy(name.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["s"]: r["n"] for r in by_source.limit(most + 1).collect()}
    if len(sizes) > most:
        ranked, sizes, weights = _pooled(row, name, by_source, weights, most, resolution)
    else:
        weights = tempered_weights(sizes, resolution) if weights is None else weights
        ranked = _ranked(row, name, sizes)
    block = F.floor((F.col("rank") - 1) / block_docs) + 1
    offset = (F.col("rank") - 1) % block_docs
    plan = phases(weights, sizes, block_docs)
    starts = [
        (s, i, p["from"][s], p["from"][s] + p["taken"][s], n, p["total"], p["place"])
        for i, p in enumerate(plan)
        for s, n in p["weights"].items()
    ]
    slots = [(s, i, j, slot) for i, p in enumerate(plan) for s in p["weights"] for j, slot in enumerate(p["slots"][s])]
    when = spark.createDataFrame(starts, "_s string, _phase int, _from long, _to long, _n int, _total int, _place long")
    pattern = spark.createDataFrame(slots, "_s2 string, _phase2 int, _j int, _slot int")
    if len(slots) <= BROADCAST_SLOTS and len(starts) <= BROADCAST_SLOTS:
        when, pattern = F.broadcast(when), F.broadcast(pattern)
    placed = (
        ranked.select("row", "s", block.alias("block"), offset.alias("offset"))
        .join(when, (F.col("s") == F.col("_s")) & (F.col("block") > F.col("_from")) & (F.col("block") <= F.col("_to")))
        .withColumn("local", F.col("block") - F.col("_from") - 1)
        .join(
            pattern,
            (F.col("s") == F.col("_s2"))
            & (F.col("_phase") == F.col("_phase2"))
            & ((F.col("local") % F.col("_n")).cast("int") == F.col("_j")),
        )
    )
    slot = F.floor(F.col("local") / F.col("_n")) * F.col("_total") + F.col("_slot")
    result = placed.select(
        "row.*",
        (F.col("_place") + slot * block_docs + F.col("offset")).cast("long").alias("mix_position"),
        F.col("_phase").alias("mix_phase"),
        slot.cast("long").alias("mix_slot"),
        F.col("block").cast("long").alias("mix_block"),
    )
    return result.repartitionByRange("mix_position").sortWithinPartitions("mix_position") if in_order else result


def _ranked(docs: DataFrame, name: Column, sizes: Mapping[str, int]) -> DataFrame:
    """``row``, ``s`` and its 1-based ``rank`` within the source, without a task per source."""
    spark = docs.sparkSession
    hashed = docs.select(F.struct("*").alias("row"), name.alias("s"), *_order_key())
    known = spark.createDataFrame(list(sizes.items()), "s string, n long")
    return _ranks(hashed.join(F.broadcast(known), "s"), _along_hash(), "o1", "o2").select("row", "s", "rank")


def _along_hash() -> Column:
    return F.col("o1") / F.lit(2.0**64) + 0.5


def _ranks(rows: DataFrame, along: Column, *order: str) -> DataFrame:
    """``rows`` with the 1-based ``rank`` by ``order`` within their ``s``, which has ``n`` rows.

    The rows of an ``s`` are cut into buckets along ``along``, which goes up with the order
    from 0 to 1, a bucket for every so many rows; ranks within the buckets go up by the
    sizes of the buckets before.
    """
    buckets = F.greatest(F.lit(1), F.floor(F.col("n") / ROWS_PER_BUCKET)).cast("int")
    cut = F.floor(along * buckets).cast("int")
    bucketed = rows.withColumn("bucket", F.greatest(F.lit(0), F.least(cut, buckets - 1)))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        bucketed.groupBy("s", "bucket")
        .agg(F.count(F.lit(1)).alias("in_bucket"))
        .select("s", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("first"))
    )
    inside = F.row_number().over(Window.partitionBy("s", "bucket").orderBy(*order))
    return (
        bucketed.withColumn("inside", inside)
        .join(firsts, ["s", "bucket"])
        .withColumn("rank", F.col("first") + F.col("inside"))
        .drop("bucket", "inside", "first")
    )


def _pooled(
    docs: DataFrame, name: Column, by_source: DataFrame, weights: Mapping[str, int] | None, single: int, resolution: int
) -> tuple[DataFrame, dict[str, int], dict[str, int]]:
    """As ``_ranked``, for any number of sources: ``s`` is a source of the largest weights or a pool of
    others. With it, the documents and the weight of each ``s``."""
    spark = docs.sparkSession
    if weights is None:
        sized = by_source.withColumn("w", F.floor(F.sqrt("n") * ROOT_PARTS).cast("long"))
    else:
        sized = by_source.join(spark.createDataFrame(list(weights.items()), "s string, w long"), "s")
    sized = stored(sized, "sources")
    largest = [r["s"] for r in sized.orderBy(F.desc("w"), "s").limit(single).select("s").collect()]
    alone = F.broadcast(spark.createDataFrame([(s,) for s in largest], "s string"))
    factor = lambda x: F.floor(F.log2(x)).cast("string")
    pool = F.concat_ws("/", F.lit("pool"), factor(F.col("w")), factor(F.col("n") / F.col("w")))
    heads = sized.join(alone, "s").withColumn("g", F.concat(F.lit("source/"), "s"))
    members = stored(sized.join(alone, "s", "left_anti").withColumn("g", pool), "pooled-sources")
    totals = (
        heads.unionByName(members)
        .groupBy("g")
        .agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.col("n") / F.col("w")).alias("longest"))
        .collect()
    )
    pools = spark.createDataFrame(
        [(r["g"], r["n"], r["longest"]) for r in totals], "g string, in_pool long, longest double"
    )

    hashed = docs.select(F.struct("*").alias("row"), name.alias("s"), *_order_key())
    by_head = _ranks(hashed.join(F.broadcast(heads), "s"), _along_hash(), "o1", "o2")
    of_pools = _ranks(hashed.join(alone, "s", "left_anti").join(members, "s"), _along_hash(), "o1", "o2")
    start = F.xxhash64("s") / F.lit(2.0**64) + 0.5
    timed = of_pools.withColumn("time", (F.col("rank") - start) / F.col("w")).join(F.broadcast(pools), "g")
    timed = timed.select("row", F.col("s").alias("member"), F.col("g").alias("s"), F.col("in_pool").alias("n"), "longest", "time")
    placed = _ranks(timed, F.col("time") / F.col("longest"), "time", "member")
    ranked = by_head.select("row", F.col("g").alias("s"), "rank").unionByName(placed.select("row", "s", "rank"))
    found = {r["g"]: r["w"] for r in totals}
    return ranked, {r["g"]: r["n"] for r in totals}, _whole(found, resolution) if weights is None else found


def _order_key() -> list[Column]:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(key, text).alias("o1"), F.xxhash64(text, key).alias("o2")]
