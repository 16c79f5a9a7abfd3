"""N-gram Jaccard join by token-combination prefixes, and the groups of near copies.

A document's set holds the hashes of its word shingles. Shingles stand in one global
order: rare ones first, then frequent ones, each by hash. Whatever differs between two
similar sets is few shingles, so both must share something at the start of this order.
For rare shingles that is a single one. A frequent shingle alone would meet too many
documents; frequent shingles fall into classes, and two of one class together make a
signature. Since the first shingle taken of a class makes no signature yet, the prefix
grows by one for each class it touches; then the pigeonhole argument holds as before.

Signatures only propose pairs: texts are compared in full. A pair falls away beforehand if
what its first shared signature leaves is too little, or if too many slots of the sets'
parities differ, each of which holds a token of one set alone. Members of a signature are
compared with a few pivots first, among them the one with the fewest rare tokens, to which
near copies are nearest; what these comparisons connect needs no further ones, so a large
group of near copies costs steps in proportion to its size. All pairs that share a
signature and are not connected by then are compared as well, which leaves no link out.

Tables in between go into as many files as their rows ask for, however many partitions the
shuffle before them has. A file costs more than its rows if they are few: a task, and in a
local file system without Hadoop's native code commands that set its permissions.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.common import (
    BATCH_KEY,
    SHORT_ROWS_PER_BATCH,
    SHUFFLE_CLEANUP_KEY,
    content_key,
    dropped,
    setting,
    small_batches,
    stored,
)
from vertexloom.runtime import partitions_for

SHINGLE = 5
PERCENT = 75
SKETCH_BITS, SLICES = 20, 64
TOKENS_PER_CLASS = 16
PARITIES = 8
PIVOT_ORDERS = 3
SETS_SEEN = 500_000
SALTS = 1_024
NUMBERS_PER_FILE, TOKENS_PER_FILE, TEXTS_PER_FILE = 100_000, 1_000_000, 5_000


def _numbers(name: str, count: int) -> np.ndarray:
    """Fixed odd numbers of 64 bits without a pattern."""
    return np.array(
        [int.from_bytes(blake2b(f"{name} {i}".encode(), digest_size=8).digest(), "little") | 1 for i in range(count)],
        np.uint64,
    )


_ODD, _OF_BYTE = _numbers("odd", 16), _numbers("byte", 256)
PARITY = [f"p{i}" for i in range(PARITIES)]
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes.

    A word's hash is a sum over its bytes of a number for the byte times a power for its
    place in the word. Sums over the whole text give those of all its words at once.
    """

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, length: int) -> None:
        if len(self.power) < length:
            length = max(length, 1 << 16, 2 * len(self.power))
            for name, base in (("power", int(_ODD[12])), ("inverse", pow(int(_ODD[12]), -1, 1 << 64))):
                factors = np.full(length, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of what ASCII white space parts, A-Z lower-cased."""
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self._powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_OF_BYTE[data] * self.power[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def tokens(self, text: str | None) -> np.ndarray:
        """Fewer words than a shingle's are one shingle; no words are none."""
        hashes = self.words(text)
        if not len(hashes):
            return hashes
        n = min(self.size, len(hashes))
        count = len(hashes) - n + 1
        total = hashes[:count] * _ODD[0] + np.uint64(n)
        for i in range(1, n):
            total += hashes[i : count + i] * _ODD[i]
        total = mixed(total)
        total.sort()
        return total[np.append(True, total[1:] != total[:-1])]


def outline(tokens: np.ndarray) -> bytes:
    """Counts of tokens by slot, with about two tokens to a slot; empty if a count does not fit a byte."""
    slots = 1 << max(6, (len(tokens) // 2).bit_length())
    counts = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def may_be_similar(left: bytes, right: bytes, percent: int) -> bool:
    """False only for sets whose outlines leave too little in common."""
    if not left or not right:
        return True
    a, b = np.frombuffer(left, np.uint8).astype(np.int64), np.frombuffer(right, np.uint8).astype(np.int64)
    if len(a) > len(b):
        a, b = b, a
    b = b.reshape(-1, len(a)).sum(axis=0)
    common = int(np.minimum(a, b).sum())
    return 100 * common >= percent * (int(a.sum()) + int(b.sum()) - common)


def parity(tokens: np.ndarray, numbers: int = PARITIES) -> list[int]:
    """For each slot, whether an odd number of tokens falls into it: so many numbers of 64 bits.

    Slots in which two sets differ hold a token that only one of them has.
    """
    odd = np.bincount((tokens >> np.uint64(32) & np.uint64(64 * numbers - 1)).astype(np.int64), minlength=64 * numbers) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def wide_parity(tokens: np.ndarray) -> list[int] | None:
    """The same with two slots or more to a token, for sets that would crowd the others."""
    numbers = 1 << max(0, (2 * len(tokens) - 1).bit_length() - 6)
    return parity(tokens, numbers) if numbers > PARITIES else None


def digest(tokens: np.ndarray) -> tuple[int, int]:
    both = blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def _reader(size: int):
    """One row per document with its set's size and digest, and at the end the task's token counts."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, counts = Shingler(size), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            sets = [shingler.tokens(t) for t in batch["text"]]
            slots = (np.concatenate([np.zeros(0, np.uint64), *sets]) & np.uint64(len(counts) - 1)).astype(np.int64)
            counts += np.bincount(slots, minlength=len(counts))
            both = [digest(tokens) for tokens in sets]
            yield batch[["doc_id", "_k1", "_k2"]].assign(
                n=[len(t) for t in sets],
                d1=[d for d, _ in both],
                d2=[d for _, d in both],
                outline=[outline(t) for t in sets],
                **dict(zip(PARITY, np.array([parity(t) for t in sets], np.int64).reshape(-1, PARITIES).T, strict=True)),
                wide=[wide_parity(t) for t in sets],
                slice=-1,
                counts=None,
            )
        if counts.any():
            parts = [part.tobytes() for part in counts.reshape(SLICES, -1)]
            yield pd.DataFrame(
                {
                    **{"doc_id": None, "_k1": 0, "_k2": 0, "n": 0, "d1": 0, "d2": 0, "outline": None},
                    **dict.fromkeys(PARITY, 0),
                    "wide": None,
                    **{"slice": range(SLICES), "counts": parts},
                }
            )

    return read


def _added_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch["slice"], batch["counts"], strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(part, np.int64)
    yield pd.DataFrame({"slice": list(sums), "counts": [x.tobytes() for x in sums.values()]})


def frequent_tokens(read: DataFrame) -> np.ndarray:
    """For each slot of the token counts, whether its tokens count as frequent: 1 << SKETCH_BITS bits, packed."""
    counts = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), np.int64)
    parts = read.where("slice >= 0").select("slice", "counts").repartition(SLICES, "slice")
    for row in parts.mapInPandas(_added_up, "slice int, counts binary").collect():
        counts[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    mean = counts.mean()
    return np.packbits(counts.ravel() > mean + 6 * mean**0.5 + 16)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the single tokens (even) and the pairs of tokens (odd) of a set's prefix, and their reach.

    The reach bounds what the set has in common with another one if this is the first
    signature that they share: the tokens from there on, and for a pair one more for each
    class, as one common token of a class makes no signature. A set has pairs only if all
    of its rare tokens are signatures too, so sets that first share a pair have no rare
    token in common, and the reach is no more than the number of frequent ones.
    """
    n = len(tokens)
    if n < 2:  # one token is similar to itself only, and equal sets are one class
        return tokens[:0], np.zeros(0, np.int64)
    least = -(-percent * n // 100)
    wanted = n - least + 1
    slot = (tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)
    often = (frequent[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)
    rare = tokens[~often][:wanted]
    wanted -= len(rare)
    one = np.uint64(1)
    alone = n - np.arange(len(rare))
    if wanted <= 0:
        return rare & ~one, alone
    often, found, reach = tokens[often], [rare & ~one], [alone]
    after_rare = n - len(rare) + max(1, (1 << (n.bit_length() - 1)) // TOKENS_PER_CLASS)
    # The number of classes goes by the smaller set of a pair, up to a power of two.
    for scale in range(least.bit_length(), n.bit_length() + 1):
        classes = max(1, (1 << (scale - 1)) // TOKENS_PER_CLASS)
        of = (mixed(often * _ODD[15]) % np.uint64(classes)).astype(np.int64)
        first = np.zeros(len(often), bool)
        first[np.unique(of, return_index=True)[1]] = True
        end = int(np.searchsorted(np.cumsum(~first), wanted)) + 1
        order = np.argsort(of[:end], kind="stable")
        by_class, start = often[:end][order], 0
        after = np.minimum(after_rare - order, n - len(rare))
        for stop in [*(np.flatnonzero(np.diff(of[:end][order])) + 1).tolist(), len(order)]:
            left, right = np.triu_indices(stop - start, 1)
            group = by_class[start:stop]
            found.append(mixed(group[left] * _ODD[13] + group[right] * _ODD[14] + np.uint64(scale)) | one)
            reach.append(after[start:stop][left])
            start = stop
    return np.concatenate(found), np.concatenate(reach)


def _signer(size: int, frequent: np.ndarray, percent: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, seen = Shingler(size), set()
        for batch in batches:
            sigs, names, reach = [], [], []
            for text in batch["text"]:
                tokens = shingler.tokens(text)
                name = digest(tokens)[0]
                if name in seen:
                    continue  # a copy of what this task has signed
                if len(seen) >= SETS_SEEN:
                    seen.clear()
                seen.add(name)
                own, after = signatures(tokens, frequent, percent)
                sigs.append(own.view(np.int64))
                reach.append(after)
                names.append(np.full(len(own), name, np.int64))
            if sigs:
                yield pd.DataFrame(
                    {"sig": np.concatenate(sigs), "d1": np.concatenate(names), "reach": np.concatenate(reach)}
                )

    return sign


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by signature and set, each once, those of signatures with several sets.

    Pairs of frequent tokens are spread over tasks, so their rows all stay.
    """
    columns = ["sig", "d1", "reach"]
    last, kept = None, False
    for batch in batches:
        rows = batch[columns].to_numpy(np.int64)
        if not len(rows):
            continue
        if last is not None:
            rows = np.vstack([last[None, :], rows])
        rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))]
        same = rows[1:, 0] == rows[:-1, 0]
        keep = np.append(same, False) | np.append(False, same) | (rows[:, 0] & 1 == 1)
        keep[0] |= kept
        # The last row waits for the next batch, which may have more of its signature.
        last, kept = rows[-1], keep[-1]
        yield pd.DataFrame(rows[:-1][keep[:-1]], columns=columns)
    if last is not None and kept:
        yield pd.DataFrame(last[None, :], columns=columns)


def _may_be_similar(percent: int):
    @F.pandas_udf("boolean")
    def similar(lefts: pd.Series, rights: pd.Series) -> pd.Series:
        found = [may_be_similar(a, b, percent) for a, b in zip(lefts, rights, strict=True)]
        return pd.Series(found, dtype="bool")

    # Else Spark moves the filter below a coalesce, and a task starts it for each partition joined.
    return similar.asNondeterministic()


def _similar(size: int, percent: int):
    @F.pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingler, text, tokens = Shingler(size), None, None
        for lefts, rights in batches:
            out = []
            for left, right in zip(lefts, rights, strict=True):
                if left != text or tokens is None:
                    text, tokens = left, shingler.tokens(left)
                other = shingler.tokens(right)
                common = len(np.intersect1d(tokens, other, assume_unique=True))
                out.append(100 * common >= percent * (len(tokens) + len(other) - common))
            yield pd.Series(out, dtype="bool")

    return similar.asNondeterministic()


def files_for(spark: SparkSession, rows: int, per_file: float) -> int:
    """Files, and tasks that write them, for ``rows`` rows: as many as can run at once, or more for many rows."""
    return max(spark.sparkContext.defaultParallelism, ceil(rows / per_file))


def connected(links: DataFrame, count: int) -> DataFrame:
    """``node`` and ``label``, the smallest node that the ``count`` links reach, of all nodes with links.

    Labels spread and jump. A round writes once, into as many files as there are links for.
    """
    files = partitions_for(links.sparkSession, 2 * count)
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(links.select(F.inline(ends)), "links")
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    first = nearest.select("node", F.least("node", "near").alias("label"), F.lit(True).alias("moved"))
    labels = stored(first.coalesce(files), "labels")
    while not labels.where("moved").isEmpty():
        known = labels.select("node", "label")
        near = both.join(known, both.b == known.node).groupBy("a").agg(F.min("label").alias("near"))
        lower = known.join(near, known.node == near.a).select("node", "label", F.least("label", "near").alias("new"))
        jump = lower.select(F.col("node").alias("at"), F.col("new").alias("further"))
        further = (
            lower.join(jump, F.col("new") == F.col("at"))
            .select("node", F.least("new", "further").alias("to"), "label")
            .select("node", F.col("to").alias("label"), (F.col("to") < F.col("label")).alias("moved"))
        )
        before, labels = labels, stored(further.coalesce(files), "labels")
        dropped(before)
    dropped(both)
    return labels.select("node", "label")


def groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``_k1``, ``_k2``, ``n_shingles`` and ``first`` of every row of ``docs``.

    ``first`` (a struct with ``doc_id`` and the content key) is the same for all documents
    of a group: its member with the smallest id. Two documents link when their sets share
    at least ``percent`` of what they have in all; groups are what links reach. A document
    of fewer than ``size`` words has one shingle, its words; one without words, or with a
    null text, has none and is a group of its own, and so is each such row. Rows equal in
    id and text are copies like any others. Null ids come after all others.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Every step reads what the steps before have stored, and none runs twice, so what a step
    # shuffled may go with it.
    with setting(spark, SHUFFLE_CLEANUP_KEY, "true"):
        return _groups(docs, size, percent)


def _groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType
    # The id goes through Python as text: pandas would make a column with nulls one of floats.
    texts = docs.select(F.col("doc_id").cast("string"), *content_key(F.col("doc_id"), F.col("text")), "text")
    longs = ", ".join(f"{c} long" for c in ("_k1", "_k2", "n", "d1", "d2"))
    columns = f"doc_id string, {longs}, outline binary, {', '.join(f'{p} long' for p in PARITY)}, wide array<long>, slice int, counts binary"
    read = stored(texts.mapInPandas(_reader(size), columns), "shingle-sets")
    own = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "_k1", "_k2")
    per_row = read.where("slice < 0").withColumn("doc_id", F.col("doc_id").cast(id_type))
    sets = per_row.select("doc_id", "_k1", "_k2", "n", "d1", "d2", own.alias("own"))
    by_set = per_row.where("n > 0").withColumn("own", own).groupBy("d1", "d2")
    classes = by_set.agg(F.min("own").alias("first"), F.max("n").alias("n"), F.max("outline").alias("outline"), *[F.max(p).alias(p) for p in [*PARITY, "wide"]])

    all_docs, all_tokens = per_row.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    per_file = min(TEXTS_PER_FILE, TOKENS_PER_FILE * all_docs / max(1, all_tokens)) or 1
    for_docs = files_for(spark, all_docs, per_file)
    frequent = frequent_tokens(read)
    pair = "sig long, d1 long, reach long"
    signed = texts.select("text").mapInPandas(_signer(size, frequent, percent), pair)
    # A rare token has few sets, which meet in one task. A pair of frequent ones may have
    # very many, so those rows are spread and pass.
    salt = F.when(F.col("sig") % 2 == 0, F.lit(0)).otherwise(F.pmod("d1", F.lit(SALTS)))
    ordered = signed.repartition(F.col("sig"), salt).sortWithinPartitions("sig", "d1")
    # Rows of three numbers, very many of them: batches as for whole texts would cost more than the work.
    with setting(spark, BATCH_KEY, str(SHORT_ROWS_PER_BATCH)):
        shared = stored(ordered.coalesce(for_docs).mapInPandas(_shared, pair), "shared-signatures")
    for_members = files_for(spark, shared.count(), NUMBERS_PER_FILE)
    involved = shared.select("d1").distinct()
    numbered = classes.join(involved, "d1", "left_semi").withColumn("node", F.monotonically_increasing_id())
    nodes = stored(numbered.coalesce(for_docs), "classes")
    met = shared.join(nodes.select("d1", "node", "n"), "d1")
    members = stored(met.select("sig", "node", "n", "reach").coalesce(for_members), "members")
    dropped(shared)
    outlines = nodes.select("node", "outline")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of stored pairs ``a``, ``b`` of nodes, those whose texts are similar."""
        files = files_for(spark, pairs.count(), per_file)
        met = pairs.join(outlines.toDF("b", "right"), "b").join(outlines.toDF("a", "left"), "a")
        met = met.coalesce(files).where(_may_be_similar(percent)("left", "right")).select("a", "b")
        likely = stored(met, "likely-pairs")
        of_pairs = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        wanted = nodes.join(of_pairs, "node").select(
            "node", F.col("first._k1").alias("_k1"), F.col("first._k2").alias("_k2")
        )
        found = texts.join(wanted, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
        found = stored(found.select("node", "text").coalesce(for_docs), "texts-of-pairs")
        files = files_for(spark, likely.count(), per_file)
        met = likely.join(found.toDF("b", "right"), "b").join(found.toDF("a", "left"), "a")
        met = met.coalesce(files).where(_similar(size, percent)("left", "right")).select("a", "b")
        return stored(met, "links")

    # At the first signature that two sets share, their reach bounds what they have in
    # common. Later ones may fall short of the bound; the first one of similar sets never does.
    both_n = F.col("n") + F.col("other_n")
    possible = F.least("reach", "other_reach") * (100 + percent) >= both_n * percent
    order = F.xxhash64(F.pmod("sig", F.lit(PIVOT_ORDERS)), "node")
    facts = ["node", "n", "reach"]
    smallest = F.min(F.struct("n", order.alias("o"), *[c for c in facts if c != "n"])).alias("low")
    any_one = F.min(F.struct(order.alias("o"), *facts)).alias("any")
    plain = F.floor(F.col("reach") * 1_000 / F.col("n")).alias("part")
    most_common = F.max(F.struct(plain, order.alias("o"), *facts)).alias("most")
    all_three = F.array(*[F.struct(*[F.col(f"{p}.{c}") for c in facts]) for p in ("low", "any", "most")])
    chosen = members.groupBy("sig").agg(smallest, any_one, most_common)
    pivots = chosen.select("sig", F.explode(F.array_distinct(all_three)).alias("p"))

    def other(name: str) -> str:
        return "other" if name == "node" else f"other_{name}"

    pivots = pivots.select("sig", *[F.col(f"p.{c}").alias(other(c)) for c in facts])
    stars = members.join(pivots, "sig").where((F.col("node") != F.col("other")) & possible)
    pair_of = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
    tried = stored(stars.select(*pair_of).distinct().coalesce(for_members), "pairs")
    links = linked(tried)
    reached = connected(links, links.count())
    label = nodes.select("node").join(reached, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    label = stored(label.coalesce(partitions_for(spark, nodes.count())), "labels")
    dropped(reached)

    # Signatures whose sets are not all connected; of those with the same sets the first,
    # which has the largest reach for each of them.
    placed = members.join(label, "node")
    open_sigs = (
        placed.groupBy("sig")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y"),
            F.count(F.lit(1)).alias("size"),
            F.sum("reach").alias("reach"),
        )
        .where("low < high")
        .groupBy("x", "y", "size")
        .agg(F.max_by("sig", "reach").alias("sig"))
    )
    parities = [*PARITY, "wide"]
    left = placed.join(open_sigs.select("sig"), "sig").join(nodes.select("node", *parities), "node")
    left = stored(left.coalesce(for_members), "open-members")

    def few(differ: Column) -> Column:
        # Slots of odd counts in which two sets differ hold a token that one of them lacks.
        return differ * (100 + percent) <= both_n * (100 - percent)

    near = few(sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"other_{p}"))) for p in PARITY), F.lit(0)))
    slots = F.zip_with("wide", "other_wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    nearer = F.when(F.size("wide") == F.size("other_wide"), few(F.aggregate(slots, F.lit(0), lambda total, x: total + x)))
    rest = (
        left.join(left.select("sig", *[F.col(c).alias(other(c)) for c in [*facts, "label", *parities]]), "sig")
        .where((F.col("label") < F.col("other_label")) & possible & near & F.coalesce(nearer, F.lit(True)))
        .select(*pair_of)
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    # What the groups so far are linked by joins them as wholes, so that the first links are
    # not gone through again.
    late = linked(stored(rest.coalesce(for_members), "late-pairs"))
    grouped = nodes.join(label, "node").select("d1", "d2", "first", "label")
    if count := late.count():
        ends = [label.toDF(c, f"of_{c}") for c in ("a", "b")]
        between = late.join(ends[0], "a").join(ends[1], "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        joined = connected(between.coalesce(partitions_for(spark, count)), count).toDF("label", "all")
        grouped = grouped.join(joined, "label", "left").withColumn("label", F.coalesce("all", "label")).drop("all")
    firsts = grouped.groupBy("label").agg(F.min("first").alias("group_first"))
    of_groups = grouped.join(firsts, "label").select("d1", "d2", "group_first")
    # Written first, so that the join below has a shuffle on either side, which Spark can
    # split where very many rows have one set.
    of_sets = classes.join(of_groups, ["d1", "d2"], "left").select(
        "d1", "d2", F.coalesce("group_first", "first").alias("first")
    )
    found = stored(of_sets.coalesce(for_docs), "firsts")
    result = ["doc_id", "_k1", "_k2", F.col("n").alias("n_shingles"), "first"]
    with_words = sets.where("n > 0").join(found, ["d1", "d2"]).select(*result)
    without = sets.where("n = 0").withColumn("first", F.col("own")).select(*result)
    return with_words.unionByName(without).coalesce(for_docs)


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest id; rows without words all stay."""
    mine = (F.col("first._k1") == F.col("_k1")) & (F.col("first._k2") == F.col("_k2"))
    has_words = (F.col("n_shingles") > 0).alias("_words")
    kept = groups(docs, size, percent).where(mine).select("_k1", "_k2", has_words).distinct()
    rows = docs.select(F.struct("*").alias("_row"), *content_key(F.col("doc_id"), F.col("text")))
    met = rows.join(kept, ["_k1", "_k2"])
    with_words = met.where("_words").dropDuplicates(["_k1", "_k2"])
    return with_words.select("_row").unionByName(met.where("not _words").select("_row")).select("_row.*")
