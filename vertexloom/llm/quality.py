"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes run in overlapping chunks through learned filters. Beside the bytes of
its window, a filter sees whether the same bytes stand a few places before, which shows
words repeated over and over. Each filter keeps its maximum and its mean over all chunks,
so the whole document counts, however long, in memory for one chunk. A logistic layer
combines them into one probability. The network is fitted once, on a bounded sample of
labelled rows; scoring is a pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vertexloom.llm.common import fold, small_batches

SAMPLE_ROWS, SAMPLE_BYTES = 2_000, 16_000_000
THRESHOLD = 0.7
WIDTH, STRIDE, FILTERS, DEPTH = 8, 2, 24, 6
CHUNK, OVERLAP, FARTHEST = 4_096, 48, 40
STEPS, BATCH = 640, 16


class ByteCnn:
    """Weights and the forward pass; ``fit`` learns them by Adam on the logistic loss."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.weights = {
            "bytes": rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
            "filters": rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH + 1, FILTERS)).astype(np.float32),
            "shift": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "bias": np.zeros(1, np.float32),
        }
        self.trained = False

    def chunks(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Byte windows (one row each) of every chunk, and whether a window also stands a few bytes before."""
        if len(data) < WIDTH:
            data = np.concatenate([data, np.full(WIDTH - len(data), 32, np.uint8)])
        for start in range(0, len(data) - WIDTH + 1, CHUNK):
            piece = data[max(0, start - OVERLAP) : start + CHUNK + WIDTH - 1]
            windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(piece, WIDTH))
            as_number = windows.view(np.uint64).ravel()
            repeats = np.zeros(len(windows), bool)
            for back in range(2, min(FARTHEST, len(windows) - 1) + 1):
                repeats[back:] |= as_number[back:] == as_number[:-back]
            yield windows[::STRIDE], repeats[::STRIDE]

    def inputs(self, windows: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        vectors = self.weights["bytes"][windows].reshape(len(windows), -1)
        return np.concatenate([vectors, repeats[:, None].astype(np.float32)], axis=1)

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Maximum and mean of every filter over all chunks."""
        most, total, count = np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float64), 0
        for chunk in self.chunks(data):
            act = np.maximum(self.inputs(*chunk) @ self.weights["filters"] + self.weights["shift"], 0)
            most = np.maximum(most, act.max(axis=0))
            total += act.sum(axis=0)
            count += len(act)
        return np.concatenate([most, (total / count).astype(np.float32)])

    def score(self, text: str | None) -> float:
        data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        return float(self.logistic(self.pooled(data) @ self.weights["out"] + self.weights["bias"][0]))

    @staticmethod
    def logistic(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, data: np.ndarray, label: float, weight: float) -> dict[str, np.ndarray]:
        w = self.weights
        windows, repeats = (np.concatenate(x) for x in zip(*self.chunks(data), strict=True))
        inputs = self.inputs(windows, repeats)
        act = np.maximum(inputs @ w["filters"] + w["shift"], 0)
        top = act.argmax(axis=0)
        features = np.concatenate([act.max(axis=0), act.mean(axis=0)])
        error = weight * (self.logistic(features @ w["out"] + w["bias"][0]) - label)
        back = np.repeat(error * w["out"][None, FILTERS:] / len(act), len(act), axis=0)
        back[top, np.arange(FILTERS)] += error * w["out"][:FILTERS]
        back = (back * (act > 0)).astype(np.float32)
        to_bytes = np.zeros_like(w["bytes"])
        by_input = (back @ w["filters"][:-1].T).reshape(-1, DEPTH)
        for d in range(DEPTH):
            to_bytes[:, d] = np.bincount(windows.ravel(), by_input[:, d], 256)
        return {
            "bytes": to_bytes,
            "filters": inputs.T @ back,
            "shift": back.sum(axis=0),
            "out": (error * features).astype(np.float32),
            "bias": np.array([error], np.float32),
        }

    def fit(
        self, texts: list[str | None], labels: list[int], good_share: float = 0.5, steps: int = STEPS, seed: int = 7
    ) -> ByteCnn:
        """``steps`` steps, however few rows there are. ``good_share`` of all rows have label 1, as far as is known."""
        rng = np.random.default_rng(seed)
        rows = [np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8) for t in texts]
        y = np.asarray(labels, np.float32)
        # Both labels weigh the same in sum, or the rare one would be learned last.
        share = np.clip(y.mean(), 0.02, 0.98)
        weights = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < BATCH:
                order = np.concatenate([order, *[rng.permutation(len(rows)) for _ in range(1 + BATCH // len(rows))]])
            picked, order = order[:BATCH], order[BATCH:]
            sums = {k: np.zeros_like(v) for k, v in self.weights.items()}
            for i in picked:
                for k, g in self.gradients(rows[i], y[i], weights[i]).items():
                    sums[k] += g / len(picked)
            rate = 0.01 * (1 - (step - 1) / steps)
            for k, g in sums.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                self.weights[k] = self.weights[k] - (rate * move).astype(np.float32)
        # The weights made both labels equally frequent; the odds of a row are those of all rows.
        known = float(np.clip(good_share, 0.02, 0.98))
        self.weights["bias"] = self.weights["bias"] + np.float32(np.log(known / (1 - known)))
        self.trained = True
        return self


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> ByteCnn:
    """Learn ``quality`` from the labelled rows outside the held-out fold.

    Learned from are whole texts of at most ``sample_rows`` rows: those with the smallest
    hash of their id, half of them of either label while both last, as many as have
    ``sample_bytes`` bytes together, which bounds what the driver holds. Rows without a
    text or a label take no part; of rows with one id the smallest text counts. Without
    rows of both labels nothing can be learned: ``trained`` is false, all scores are a half.
    """
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.where(fold(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = [
        marked.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2)
        for q in (0, 1)
    ]
    picked = chosen[0].unionByName(chosen[1])
    texts = docs.where(F.col("text").isNotNull() & (F.octet_length("text") <= sample_bytes)).select("doc_id", "text")
    found = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    # at most one row for each of the chosen ids
    so_far = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    rows = found.withColumn("bytes", so_far).where(F.col("bytes") <= sample_bytes).drop("bytes").collect()
    rows.sort(key=lambda r: r["doc_id"])
    model = ByteCnn()
    if len({r["quality"] for r in rows}) < 2:
        model.weights["out"][:] = 0
        return model
    share = marked.agg(F.avg("quality").alias("share")).first()["share"]
    return model.fit([r["text"] for r in rows], [r["quality"] for r in rows], share)


def scored(docs: DataFrame, model: ByteCnn) -> DataFrame:
    """``row`` and ``quality_score`` (0 to 1) of every row of ``docs``.

    The score sees the whole text and nothing else; a null text counts as an empty one.
    Extra columns travel inside ``row``; repeated rows are scored one by one.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        network = ByteCnn()
        network.weights = shared.value
        for texts in batches:
            yield texts.map(network.score).astype("float64") if len(texts) else pd.Series([], dtype="float64")

    return docs.select(F.struct("*").alias("row"), score(F.col("text")).alias("quality_score"))


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Train on ``docs`` and ``labels`` (see :func:`train`), then score all of ``docs`` (see :func:`scored`)."""
    return scored(docs, train(docs, labels, sample_rows))
