"""Hidden Markov language model: latent states learned by Baum-Welch, exact sequence likelihoods.

Frequent words are symbols of their own; there are at most ``FREQUENT`` of them, as each
makes up that share of all tokens. Any other word is a symbol for its ending, times the
word's share among the words of that ending. The state sequence thus works on a bounded
alphabet, while every word of the corpus keeps its own count. Tasks add up expected counts
over whole documents with the scaled forward-backward recursion; the sums over all tasks
give the next parameters.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vertexloom.llm.common import fold, small_batches, stored

STATES, PASSES = 8, 3
FREQUENT, ENDINGS = 50_000, 256
SMOOTHING = 20.0
SEED_DOCUMENTS = 64
END = "\n"  # no word holds white space
TOKENS_AT_ONCE, WORDS_HELD = 300_000, 200_000
SLICES = 32


def words_of(text: str | None) -> list[bytes]:
    """What ASCII white space parts, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


@dataclass
class Alphabet:
    """Symbols: frequent words, then endings, then the end of a text."""

    frequent: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    types: int
    ending_tokens: np.ndarray
    ending_types: np.ndarray

    @property
    def size(self) -> int:
        return len(self.frequent) + ENDINGS + 1

    def shares(self) -> np.ndarray:
        return (self.counts + 0.5) / (self.counts.sum() + 0.5 * self.size)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``count`` over all of ``docs``; the end of each text counts as one token."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def out() -> pd.DataFrame:
            words = [w.decode("utf-8", "replace") for w in held]
            return pd.DataFrame({"word": words, "count": list(held.values())})

        for batch in batches:
            for text in batch["text"]:
                held.update(words_of(text))
            held[END.encode()] += len(batch)
            if len(held) > WORDS_HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    parts = docs.select("text").mapInPandas(count, "word string, count long")
    return stored(parts.groupBy("word").agg(F.sum("count").alias("count")), "word-counts")


def alphabet(counts: DataFrame) -> Alphabet:
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    often = (F.col("count") > total["n"] / FREQUENT) & (F.col("word") != END)
    top = sorted(counts.where(often).collect(), key=lambda r: r["word"])
    frequent = {r["word"].encode("utf-8", "surrogatepass"): i for i, r in enumerate(top)}
    tail = F.substring(F.col("word").cast("binary"), -3, 3)
    by_ending = (
        counts.where(~often & (F.col("word") != END))
        .groupBy((F.crc32(tail) % ENDINGS).alias("ending"))
        .agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v"))
        .collect()
    )
    tokens, types = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in by_ending:
        tokens[r["ending"]], types[r["ending"]] = r["n"], r["v"]
    ends = sum(r["count"] for r in counts.where(F.col("word") == END).collect())
    symbols = np.concatenate([[r["count"] for r in top], tokens, [ends]]).astype(np.float64)
    return Alphabet(frequent, symbols, total["n"], total["v"], tokens, types)


def encoded(docs: DataFrame, known: Alphabet) -> DataFrame:
    """Texts as symbols: ``rid``, ``doc_id`` (text), ``held_out``, ``n_tokens``, ``symbols`` and the rarer words."""
    shared = docs.sparkSession.sparkContext.broadcast(known.frequent)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = shared.value
        first, end = len(frequent), len(frequent) + ENDINGS
        for batch in batches:
            symbols, lengths, rare_words, rare_counts = [], [], [], []
            for text in batch["text"]:
                words = words_of(text)
                found = [frequent.get(w, end) for w in words]
                others = [i for i, s in enumerate(found) if s == end]  # no word is the end of a text
                rare = Counter([words[i] for i in others])
                for i in others:
                    found[i] = first + ending(words[i])
                found.append(end)
                row = np.array(found, np.uint16)
                symbols.append(row.tobytes())
                lengths.append(len(row))
                rare_words.append([w.decode("utf-8", "replace") for w in rare])
                rare_counts.append(list(rare.values()))
            yield batch[["rid", "doc_id", "held_out"]].assign(
                n_tokens=lengths, symbols=symbols, rare_words=rare_words, rare_counts=rare_counts
            )

    schema = (
        "rid long, doc_id string, held_out boolean, n_tokens long, symbols binary, "
        "rare_words array<string>, rare_counts array<long>"
    )
    # Each step of the recursions goes over all texts of a group at once, so groups of like lengths
    # take the fewest steps. Sorted once here, the files keep the order for all passes.
    ordered = docs.mapInPandas(encode, schema).sortWithinPartitions(F.desc("n_tokens"), "rid")
    return stored(ordered, "encoded")


def in_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents in groups of a bounded number of tokens (or single ones), the longest first."""
    held, tokens = [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            held.append(row)
            tokens += row.n_tokens
            if tokens >= TOKENS_AT_ONCE:
                yield pd.DataFrame(held)
                held, tokens = [], 0
    if held:
        yield pd.DataFrame(held)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols by states

    @staticmethod
    def packed(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols time step by time step, and how many sequences (longest first) go on at each step."""
        lengths = np.array([len(s) for s in sequences])
        active = len(sequences) - np.searchsorted(np.sort(lengths), np.arange(lengths.max()), side="right")
        starts = np.concatenate([[0], np.cumsum(active)])
        out = np.empty(starts[-1], np.int64)
        for i, s in enumerate(sequences):
            out[starts[: len(s)] + i] = s
        return out, active

    def forward(self, sequences: list[np.ndarray]):
        """Scaled forward variables of all steps, their scales, and the log likelihoods."""
        symbols, active = self.packed(sequences)
        emitted = self.emit[symbols]
        alpha, scale = np.empty_like(emitted), np.empty(len(symbols))
        at, before = 0, None
        for n in active:
            here = slice(at, at + n)
            a = emitted[here] * (self.start if before is None else before[:n] @ self.move)
            scale[here] = a.sum(axis=1)
            a /= scale[here, None]
            alpha[here], before, at = a, a, at + n
        logs = np.log(scale)
        total, at = np.zeros(len(sequences)), 0
        for n in active:
            total[:n] += logs[at : at + n]
            at += n
        return symbols, active, emitted, alpha, scale, total

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions of whole sequences, and their log likelihood."""
        symbols, active, emitted, alpha, scale, total = self.forward(sequences)
        k = len(self.start)
        beta = np.ones((len(symbols), k))
        moves = np.zeros((k, k))
        ends = np.cumsum(active)
        for t in range(len(active) - 1, 0, -1):
            n, here = active[t], slice(ends[t] - active[t], ends[t])
            back = emitted[here] * beta[here] / scale[here, None]
            first = ends[t] - active[t] - active[t - 1]
            beta[first : first + n] = back @ self.move.T
            moves += alpha[first : first + n].T @ back
        moves *= self.move
        gamma = alpha * beta
        emissions = np.stack([np.bincount(symbols, gamma[:, s], len(self.emit)) for s in range(k)], axis=1)
        return gamma[: active[0]].sum(axis=0), moves, emissions, float(total.sum())


def _sequences(group: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    rows = [np.frombuffer(s, np.uint16) for s in group["symbols"]]
    order = np.argsort([-len(r) for r in rows], kind="stable")
    return [rows[i] for i in order], order


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch["slice"], batch["part"], strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(part)
    yield pd.DataFrame({"slice": list(sums), "part": [x.tobytes() for x in sums.values()]})


def baum_welch_pass(training: DataFrame, model: Model, shares: np.ndarray) -> Model:
    """Parameters from the expected counts of all of ``training``."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast((model.start, model.move, model.emit))
    k, size = len(model.start), len(model.emit)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = None
        for group in in_groups(batches):
            starts, moves, emissions, _ = Model(*shared.value).expected(_sequences(group)[0])
            part = np.concatenate([starts, moves.ravel(), emissions.ravel()])
            sums = part if sums is None else sums + part
        if sums is not None:
            parts = [p.tobytes() for p in np.array_split(sums, SLICES)]
            yield pd.DataFrame({"slice": range(SLICES), "part": parts})

    schema = "slice int, part binary"
    counts = training.select("n_tokens", "symbols").mapInPandas(count, schema).repartition(SLICES, "slice")
    found = {r["slice"]: np.frombuffer(r["part"]) for r in counts.mapInPandas(_summed, schema).collect()}
    if not found:
        return model
    sums = np.concatenate([found[i] for i in range(SLICES)])
    starts, moves = sums[:k] + 0.1, sums[k : k + k * k].reshape(k, k) + 0.1
    emissions = sums[k + k * k :].reshape(size, k) + SMOOTHING * shares[:, None]
    return Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0))


def train(training: DataFrame, known: Alphabet, states: int = STATES, passes: int = PASSES) -> Model:
    """Baum-Welch over all of ``training``.

    The states start from the words of ``SEED_DOCUMENTS`` documents with the smallest
    hashes, mixed with those of the corpus; this bounded choice only breaks the tie
    between states.
    """
    shares = known.shares()
    seeds = training.where("n_tokens > 20").orderBy(F.xxhash64("rid"), "rid").select("symbols").limit(SEED_DOCUMENTS)
    vectors = []
    for row in seeds.collect():
        counts = np.bincount(np.frombuffer(row["symbols"], np.uint16), minlength=known.size).astype(np.float64)
        vectors.append(counts / counts.sum())
    # Seeds far apart from each other: each next one is the farthest from those before.
    picked: list[np.ndarray] = vectors[:1]
    while vectors and len(picked) < states:
        far = [min(1 - (np.sqrt(v * p)).sum() for p in picked) for v in vectors]
        picked.append(vectors[int(np.argmax(far))])
    rng = np.random.default_rng(11)
    emit = np.stack([0.5 * shares + 0.5 * (picked[s] if s < len(picked) else shares) for s in range(states)], axis=1)
    emit = emit * rng.uniform(0.9, 1.1, emit.shape)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    model = Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    for _ in range(passes):
        model = baum_welch_pass(training, model, shares)
    return model


def score_texts(docs: DataFrame, states: int = STATES, passes: int = PASSES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row.

    Learns from the rows whose crc32 of the id, modulo 5, is not 1 (null ids count as empty
    text). ``score`` is the log10 probability of the words and the end of the text under
    the model, ``base_score`` that of smoothed word shares. A null text counts as an empty
    one: its end is its only token. Rows that repeat are scored one by one, and learned
    from as often as they stand. Without any training row all words are unseen.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema["doc_id"].dataType
    # The id goes through Python as text: pandas would make a column with nulls one of floats.
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("string").alias("doc_id"),
        (fold(F.col("doc_id"), 5) == 1).alias("held_out"),
        "text",
    )
    counts = word_counts(rows.where(~F.col("held_out")))
    known = alphabet(counts)
    texts = encoded(rows, known)
    model = train(texts.where(~F.col("held_out")), known, states, passes)
    shared = spark.sparkContext.broadcast((model.start, model.move, model.emit))
    n, v = known.tokens, known.types
    own = np.log10((known.counts + 0.5) / (n + 0.5 * (v + 1)))
    seen = known.counts > 0
    first = len(known.frequent)
    own[first : first + ENDINGS], seen[first : first + ENDINGS] = 0, False  # rarer words count one by one

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in in_groups(batches):
            sequences, order = _sequences(group)
            logs = np.empty(len(order))
            logs[order] = Model(*shared.value).forward(sequences)[-1]
            symbols = [np.frombuffer(s, np.uint16) for s in group["symbols"]]
            yield group[["rid", "doc_id", "held_out", "n_tokens"]].assign(
                n_seen=[int(seen[s].sum()) for s in symbols],
                own=[float(own[s].sum()) for s in symbols],
                path=logs / np.log(10),
            )

    schema = "rid long, doc_id string, held_out boolean, n_tokens long, n_seen long, own double, path double"
    paths = texts.select("rid", "doc_id", "held_out", "n_tokens", "symbols").mapInPandas(score, schema)

    rare = texts.select("rid", F.explode(F.arrays_zip("rare_words", "rare_counts")).alias("r")).select(
        "rid", F.col("r.rare_words").alias("word"), F.col("r.rare_counts").alias("times")
    )
    endings = spark.createDataFrame(
        [(i, float(known.ending_tokens[i] + 0.5 * (known.ending_types[i] + 1))) for i in range(ENDINGS)],
        "ending int, weight double",
    )
    tail = F.substring(F.col("word").cast("binary"), -3, 3)
    c = F.coalesce(F.col("count"), F.lit(0))
    by_row = (
        rare.join(counts, "word", "left")
        .withColumn("ending", (F.crc32(tail) % ENDINGS).cast("int"))
        .join(F.broadcast(endings), "ending")
        .groupBy("rid")
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_seen"),
            F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("rare_own"),
            F.sum(F.col("times") * F.log10((c + 0.5) / F.col("weight"))).alias("rare_path"),
        )
    )
    return paths.join(by_row, "rid", "left").select(
        F.col("doc_id").cast(id_type).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("n_seen") + F.coalesce("rare_seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("own") + F.coalesce("rare_own", F.lit(0.0))).alias("base_score"),
        (F.col("path") + F.coalesce("rare_path", F.lit(0.0))).alias("score"),
    )
