"""Best-fit packing of documents into token sequences by bin completion.

What decides a packing is how many pieces there are of each length, and there are at most
as many lengths as a sequence has tokens. So the search runs on that histogram, whose size
does not depend on the corpus: bin completion takes the largest length left, enumerates
the undominated fillings around it and branches on them, with best-fit solutions as
incumbents; a branch ends once a bound on the waste shows that it cannot save a sequence.
A filling is taken as often as the counts allow at once. Spark counts the lengths, brings
the pieces into one order by length, and gives each piece the place that the packing holds
for its rank.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vertexloom.llm.common import small_batches, stored

CAPACITY = 4096
END_ID = 1
#: Fillings that the search tries, and how many it compares around one document.
WORK, FILLINGS = 400, 12
WORDS_KEPT, WORDS_HELD, LONGEST_KEPT = 400_000, 500_000, 64
STRETCH = 1 << 20

Pattern = tuple[tuple[int, int], ...]


# --- tokens -------------------------------------------------------------------


#: Texts of these characters only are cut into words here, as the tokenizer's own rule would
#: cut them; Latin letters change case one to one, and no two of them combine.
LETTERS = "a-zß-öø-ÿ"
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ–—‘’“”„…«»€]")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
_BLANKS = re.compile(r"[\t-\r ]+")
_ENDING = "</w>"


class Encoder:
    """Texts to ids of a tokenizer, as bytes of little-endian 32-bit numbers.

    For a tokenizer that drops white space, lower-cases, and marks the ends of words. It
    never joins what ASCII white space parts, so each word is encoded once and then looked
    up. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_ENDING)]] = True
        self.known: dict[str, bytes] = {}

    def lookup(self, distinct: set[str], whole: bool) -> dict[str, bytes]:
        """Ids of these words at least; words that are new are encoded, and kept unless they are long.

        ``whole`` words are words to the tokenizer too, so that all of them can go through
        it as one text; the marked ends part them again.
        """
        words = list(distinct.difference(self.known))
        if not words:
            return self.known
        if whole:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            data, stops = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            new = dict(zip(words, [data[i:j] for i, j in zip([0, *stops], stops, strict=False)], strict=True))
        else:
            each = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            new = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(words, each, strict=True)}
        if len(self.known) + len(new) > WORDS_KEPT:
            new |= {w: self.known[w] for w in distinct.difference(new)}
            self.known = {}
        long = [w for w in new if len(w) > LONGEST_KEPT]
        found = {**self.known, **new} if long else self.known
        for w in long:
            del new[w]
        self.known.update(new)
        return found

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text. What is new among many texts is encoded at once."""
        done: list[list[bytes]] = []
        waiting: dict[bool, list[tuple[int, int, list[str]]]] = {True: [], False: []}
        held = 0

        def settle() -> None:
            for whole, pieces in waiting.items():
                ids = self.lookup(set().union(*[words for _, _, words in pieces]), whole).__getitem__
                for i, j, words in pieces:
                    done[i][j] = b"".join(map(ids, words))
                pieces.clear()

        for i, text in enumerate(texts):
            text, start = text or "", 0
            done.append([])
            while start < len(text):
                # a stretch ends at a blank, so that the words of a very long text are never all held
                stop = text.find(" ", start + STRETCH)
                piece = text[start : stop if stop >= 0 else len(text)]
                start = stop + 1 if stop >= 0 else len(text)
                whole = _OTHER.search(piece) is None
                words = _WORDS.findall(piece.lower()) if whole else _BLANKS.split(piece)
                waiting[whole].append((i, len(done[i]), words))
                done[i].append(b"")
                held += len(words)
                if held > WORDS_HELD:
                    settle()
                    held = 0
        settle()
        return [b"".join(parts) for parts in done]


def _encoded(path: str, capacity: int, end_id: int, with_ids: bool):
    kind = T.StructType().add("n", T.LongType()).add("crcs", T.ArrayType(T.LongType()))
    if with_ids:
        kind = kind.add("ids", T.ArrayType(T.BinaryType()))

    @F.pandas_udf(kind)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder(path), np.array([end_id], "<u4").tobytes()
        for texts in batches:
            rows = []
            for ids in encoder.encode(texts):
                data = ids + end
                cut = [data[i : i + 4 * capacity] for i in range(0, len(data), 4 * capacity)]
                rows.append((len(data) // 4, [zlib.crc32(c) for c in cut], cut)[: 3 if with_ids else 2])
            yield pd.DataFrame(rows, columns=["n", "crcs", "ids"][: 3 if with_ids else 2])

    return encode


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """``row``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every piece of every row of ``docs``.

    ``with_ids`` adds the ids themselves, as little-endian 32-bit numbers in ``ids``.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))
    found = rows.withColumn("e", _encoded(tokenizer, capacity, end_id, with_ids)(F.col("row.text")))
    cut = found.select("row", F.col("e.n").alias("n"), F.posexplode("e.crcs").alias("piece", "crc"), *(["e.ids"] if with_ids else []))
    start = F.col("piece").cast("long") * capacity
    return cut.select(
        "row",
        "piece",
        start.alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("n") - start).alias("length"),
        F.col("crc").alias("ids_crc32"),
        *([F.get("ids", F.col("piece")).alias("ids")] if with_ids else []),
    )


# --- the search on the histogram ----------------------------------------------


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: sequences of one content move together.

    ``counts[l]`` is the number of pieces of length l. Returns contents and how many
    sequences have them.
    """
    open_bins: list[list[list]] = [[] for _ in range(capacity + 1)]  # by room left: [pattern, number]
    rooms: list[int] = []  # rooms that hold bins, ascending

    def put(room: int, pattern: tuple, number: int) -> None:
        if not open_bins[room]:
            rooms.insert(bisect_left(rooms, room), room)
        open_bins[room].append([pattern, number])

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * length, ((length, each),), full)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            room = rooms[at]
            pattern, number = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(at)
            each = room // length
            full = min(number, left // each)
            if full:
                put(room - each * length, (*pattern, (length, each)), full)
                left -= full * each
            number -= full
            if number and left and left < each:
                put(room - left * length, (*pattern, (length, left)), 1)
                left, number = 0, number - 1
            if number:
                put(room, pattern, number)
    return [(pattern, number) for bins in open_bins for pattern, number in bins]


def fewest(counts: np.ndarray, capacity: int) -> int:
    """A lower bound on the sequences, over all ways to call lengths large, middle and small."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    half = capacity // 2
    small = np.arange(1, half + 1)
    large = number[capacity] - number[capacity - small]
    middle = number[capacity - small] - number[half]
    room = middle * capacity - (total[capacity - small] - total[half])
    rest = total[half] - total[small - 1] - room
    bounds = large + middle + np.maximum(0, -(-rest // capacity))
    return int(max(-(-int(total[capacity]) // capacity), bounds.max(initial=0)))


def fillings(counts: np.ndarray, lengths: list[int], room: int, wanted: int = FILLINGS) -> list[Pattern]:
    """Undominated ways to fill ``room`` from what is left, least waste first.

    A filling is dominated if some pieces of it could make way for one that is left out
    and at least as long as they are together; the rest would only be easier to place.
    """
    top = bisect_right(lengths, room)
    if not top:
        return [()]
    if lengths[top - 1] == room:  # one piece without waste dominates all
        return [((room, 1),)]
    found: dict[Pattern, int] = {}
    least = lengths[top - 1]  # what does not exceed the longest single piece is dominated by it

    def undominated(chosen: list[int]) -> bool:
        spare, used = room - sum(chosen), {}
        for x in chosen:
            used[x] = used.get(x, 0) + 1
        sums = {(0, 0)}
        for x in chosen:
            sums |= {(s + x, n + 1) for s, n in sums}
        for s, n in sums:
            low = s if n >= 2 else s + 1
            for x in lengths[bisect_left(lengths, low) : bisect_right(lengths, s + spare)]:
                if counts[x] > used.get(x, 0):
                    return False
        return True

    def extend(chosen: list[int], left: int, end: int) -> bool:
        """Longest pieces first; False once enough was found."""
        at = min(end, bisect_right(lengths, left))
        maximal, tried = True, 0
        while at:
            at -= 1
            length = lengths[at]
            if counts[length] <= chosen.count(length):
                continue
            maximal, tried = False, tried + 1
            if not extend([*chosen, length], left - length, at + 1) or tried >= wanted:
                return len(found) < wanted
        if maximal and room - left >= least and undominated(chosen):
            pattern = tuple((x, chosen.count(x)) for x in dict.fromkeys(chosen))
            found[pattern] = left
        return len(found) < wanted and 0 not in found.values()

    extend([], room, top)
    for first in reversed(lengths[max(0, top - 256) : top]):  # pairs without waste come first
        partner = room - first
        if partner <= first and counts[partner] > (partner == first):
            found[((first, 2),) if partner == first else ((first, 1), (partner, 1))] = 0
            break
    return sorted(found, key=lambda p: (found[p], len(p)))[:wanted] or [((least, 1),)]


def bin_completion(
    histogram: dict[int, int], capacity: int = CAPACITY, work: int = WORK
) -> tuple[list[tuple[Pattern, int]], int]:
    """Contents and numbers of as few sequences as the search finds, and a lower bound on them.

    The search ends when the bound is reached or after ``work`` fillings; every incumbent
    is a whole packing, so the answer always is one.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, number in histogram.items():
        counts[length] += number
    bound = fewest(counts, capacity)
    best = best_fit(counts, capacity)
    size = sum(number for _, number in best)
    taken: list[tuple[Pattern, int]] = []
    used = 0

    def branches() -> Iterator[tuple[Pattern, int]]:
        lengths = np.flatnonzero(counts).tolist()
        if not lengths:
            return
        largest = lengths[-1]
        counts[largest] -= 1
        around = fillings(counts, [x for x in lengths if counts[x]], capacity - largest)
        counts[largest] += 1
        for filling in around:
            content: dict[int, int] = {largest: 1}
            for length, n in filling:
                content[length] = content.get(length, 0) + n
            times = min(int(counts[length]) // n for length, n in content.items())
            yield tuple(content.items()), times

    stack = [branches()]
    while stack and size > bound and work > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if taken:
                pattern, times = taken.pop()
                used -= times
                for length, n in pattern:
                    counts[length] += n * times
            continue
        pattern, times = step
        work -= 1
        for length, n in pattern:
            counts[length] -= n * times
        used += times
        taken.append((pattern, times))
        if used + fewest(counts, capacity) >= size:  # too much waste to save a sequence
            stack.append(iter(()))
            continue
        rest = best_fit(counts, capacity)
        if used + sum(number for _, number in rest) < size:
            best = [*taken, *rest]
            size = sum(number for _, number in best)
        stack.append(branches())
    return best, bound


# --- places -------------------------------------------------------------------


def slots(packing: list[tuple[Pattern, int]], first_rank: dict[int, int]) -> pd.DataFrame:
    """Runs of pieces, consecutive in the order by length, and where they go.

    A run starts at ``rank``; each of its sequences, from ``sequence`` on, takes ``each``
    pieces of it, the first one at ``offset``.
    """
    rows, sequence, rank = [], 0, dict(first_rank)
    for pattern, number in packing:
        offset = 0
        for length, each in pattern:
            rows.append((rank[length], sequence, each, offset))
            rank[length] += number * each
            offset += length * each
        sequence += number
    frame = pd.DataFrame(rows, columns=["rank", "sequence", "each", "offset"], dtype="int64")
    return frame.sort_values("rank", ignore_index=True)


def _place(runs: pd.DataFrame):
    @F.pandas_udf(T.StructType().add("sequence_id", T.LongType()).add("offset", T.LongType()))
    def place(rank: pd.Series, length: pd.Series) -> pd.DataFrame:
        run = runs.iloc[np.searchsorted(runs["rank"], rank, side="right") - 1].reset_index(drop=True)
        beyond = rank.to_numpy() - run["rank"].to_numpy()
        each = run["each"].to_numpy()
        return pd.DataFrame(
            {"sequence_id": run["sequence"] + beyond // each, "offset": run["offset"] + length.to_numpy() * (beyond % each)}
        )

    return place


def packed(cut: DataFrame, capacity: int = CAPACITY, work: int = WORK) -> DataFrame:
    """``cut`` (any columns, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset`` added.

    Each sequence is filled from 0 without gaps. Rows may repeat: each is a piece of its
    own. The rows themselves stay as they are; an empty table gives no rows.
    """
    numbered = stored(cut.select(F.struct("*").alias("_row"), F.col("length").alias("_l"), F.monotonically_increasing_id().alias("_id")), "pieces")
    # at most one row per length
    histogram = {r["_l"]: r["n"] for r in numbered.groupBy("_l").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths = sorted(histogram)
    before = np.cumsum([0, *[histogram[x] for x in lengths]]).tolist()
    packing, _ = bin_completion(histogram, capacity, work)
    runs = slots(packing, dict(zip(lengths, before, strict=False)))

    # Ids are unique, so a length that very many pieces have still spreads over tasks. A
    # piece's rank is its place in its task plus the rows of the tasks before.
    by_length = numbered.repartitionByRange("_l", "_id").sortWithinPartitions("_l", "_id")
    at = F.monotonically_increasing_id()
    ordered = stored(
        by_length.select("_row", "_l", F.shiftright(at, 33).alias("_task"), at.bitwiseAND((1 << 33) - 1).alias("_at")), "pieces-by-length"
    )
    # one row per task
    tasks = sorted((r["_task"], r["n"]) for r in ordered.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect())
    ahead = np.cumsum([0, *[n for _, n in tasks]]).tolist()
    offsets = cut.sparkSession.createDataFrame(
        [(task, ahead[i]) for i, (task, _) in enumerate(tasks)], "_task long, _ahead long"
    )
    ranked = ordered.join(F.broadcast(offsets), "_task").withColumn("_rank", F.col("_ahead") + F.col("_at"))
    placed = ranked.withColumn("_p", _place(runs)("_rank", "_l"))
    return placed.select("_row.*", "_p.sequence_id", "_p.offset")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    work: int = WORK,
) -> DataFrame:
    """``row``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids``) of every piece.

    A document is the ids of its whole text, null as empty, and then ``end_id``; only one
    of more than ``capacity`` ids is cut. Rows that repeat are packed one by one, extra
    columns travel inside ``row``, an empty table gives no rows.
    """
    return packed(pieces(docs, tokenizer, capacity, end_id, with_ids), capacity, work)
