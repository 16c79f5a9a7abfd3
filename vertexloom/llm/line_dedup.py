"""Line dedup: lines that many documents share go, wherever they stand.

Hashes of the lines are range-partitioned and sorted by hash, document and position, so
that one pass sees the documents of a line one after the other. The pass holds back the
first documents of a line; the one that reaches the limit turns the line into a dropped
one, and all that follows streams through. The ranges cut on (hash, document), so a line
that very many documents share spreads over tasks; what stands at the ends of a task is
settled afterwards from the counts of its neighbours. The outcome is a compressed bitmap
per document, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vertexloom.llm.common import SPACES, ascii_lower, content_key, small_batches, stored

MIN_DOCUMENTS = 10
MIN_CHARS = 1
DROP, PENDING, EDGE = 0, 1, 2


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``h1``, ``h2`` of a line's key, ``_k1``, ``_k2`` of its document and ``pos``."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    key = ascii_lower(F.trim(F.col("line"), F.lit(SPACES)))
    return (
        docs.select(*content_key(F.col("doc_id"), F.col("text")), F.posexplode(lines).alias("pos", "line"))
        .select("_k1", "_k2", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"), "_k1", "_k2", "pos")
    )


def _stream(min_documents: int):
    columns = ["h1", "h2", "_k1", "_k2", "pos"]
    nothing = np.zeros((0, 5), np.int64)

    def frame(rows: np.ndarray, kind: int, documents: int = 0) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).assign(documents=documents, kind=kind)

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Dropped lines; for the first and the last key of the task its count and what is held back."""
        held, count, last, first = nothing, 0, None, True
        for batch in batches:
            rows = batch[columns].to_numpy(np.int64)
            if not len(rows):
                continue
            before = np.vstack([rows[:1] - 1 if last is None else last[None, :], rows[:-1]])
            new_key = (rows[:, :2] != before[:, :2]).any(axis=1)
            new_document = new_key | (rows[:, 2:4] != before[:, 2:4]).any(axis=1)
            starts = np.flatnonzero(new_key)
            head = starts[0] if len(starts) else len(rows)
            if head:  # the key of the last batch goes on
                count += int(new_document[:head].sum())
                held = np.vstack([held, rows[:head]])
                if count >= min_documents:
                    yield frame(held, DROP)
                    held = nothing
            if len(starts):
                if last is not None and first:  # the first key may have begun in another task
                    first = False
                    yield frame(last[None, :], EDGE, count)
                    yield frame(held, PENDING)
                counts = np.add.reduceat(new_document[head:].astype(np.int64), starts - head)
                if last is None and len(starts) > 1:
                    first = False
                    yield frame(rows[:1], EDGE, int(counts[0]))
                    if counts[0] < min_documents:
                        yield frame(rows[: starts[1]], PENDING)
                gone = np.repeat(counts >= min_documents, np.diff(np.append(starts, len(rows))))
                yield frame(rows[head:][gone], DROP)
                count = int(counts[-1])
                held = rows[starts[-1] :] if count < min_documents else nothing
            last = rows[-1]
        if last is not None:
            yield frame(last[None, :], EDGE, count)
            yield frame(held, PENDING)

    return runs


def dropped_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``_k1``, ``_k2`` and ``pos`` of the lines whose key stands in ``min_documents`` documents."""
    small_batches(docs.sparkSession)
    keys = ["h1", "h2", "_k1", "_k2"]
    schema = "h1 long, h2 long, _k1 long, _k2 long, pos long, documents long, kind int"
    marks = stored(
        line_hashes(docs, min_chars)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys, "pos")
        .mapInPandas(_stream(min_documents), schema),
        "line-marks",
    )
    counts = marks.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.sum("documents").alias("n"))
    shared = counts.where(F.col("n") >= min_documents)
    settled = marks.where(F.col("kind") == PENDING).join(shared, ["h1", "h2"], "left_semi")
    dropped = marks.where(F.col("kind") == DROP).select("_k1", "_k2", "pos")
    return dropped.unionByName(settled.select("_k1", "_k2", "pos"))


@F.pandas_udf(T.BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    """One bit per line up to the last dropped one, whole bytes: 1 keeps; lines beyond are kept."""

    def bits(dropped) -> bytes:
        keep = np.ones((max(dropped) // 8 + 1) * 8, np.uint8)
        keep[np.asarray(dropped)] = 0
        return zlib.compress(np.packbits(keep).tobytes())

    return positions.map(bits)


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("n_dropped", T.LongType()))
def _apply(text: pd.Series, bitmap: pd.Series) -> pd.DataFrame:
    def cut(whole, bits):
        if bits is None:
            return None, 0
        lines = (whole or "").split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))
        gone = set(np.flatnonzero(keep == 0).tolist())
        return "\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone)

    out = [cut(t, b) for t, b in zip(text, bitmap, strict=True)]
    return pd.DataFrame({"text": pd.Series([t for t, _ in out], dtype=object), "n_dropped": [n for _, n in out]})


def keep_bitmaps(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Compressed keep bitmap by document key, for the documents that lose a line."""
    dropped = dropped_lines(docs, min_documents, min_chars)
    by_document = dropped.groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("positions"))
    return by_document.select("_k1", "_k2", _bitmap("positions").alias("keep"))


def dedup_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``row``, the ``text`` that is left, ``n_lines`` (before) and ``n_dropped`` of every row of ``docs``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys
    of ``min_chars`` or more code points that stand in ``min_documents`` documents or more
    lose all their lines. A null or empty text is one empty line. Documents are told apart
    by id and text: rows that agree in both count as one document, and each of them gets
    the result. A text whose lines all go is empty. Extra columns travel inside ``row``.
    """
    bitmaps = keep_bitmaps(docs, min_documents, min_chars)
    rows = docs.select(F.struct("*").alias("row"), *content_key(F.col("doc_id"), F.col("text")))
    met = rows.join(bitmaps, ["_k1", "_k2"], "left")
    cut = met.withColumn("cut", _apply(F.when(F.col("keep").isNotNull(), F.col("row.text")), "keep"))
    whole = F.coalesce(F.col("row.text"), F.lit(""))
    return cut.select(
        "row",
        F.coalesce(F.col("cut.text"), whole).alias("text"),
        (F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.col("cut.n_dropped").alias("n_dropped"),
    )
