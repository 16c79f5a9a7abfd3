"""What the operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.runtime import delete_path, stored  # noqa: F401

BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 512
SHORT_ROWS_PER_BATCH = 32_768
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids count as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def content_key(*columns: Column) -> list[Column]:
    """Two longs that tell rows apart by the values of ``columns``, nulls included.

    Together they are a hash of 128 bits; rows that agree in all columns share it.
    """
    marks = [F.isnull(c) for c in columns]
    return [
        F.xxhash64(F.lit(1), *columns, *marks).alias("_k1"),
        F.xxhash64(F.lit(2), *reversed(columns), *marks).alias("_k2"),
    ]


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that :func:`stored` has written and nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def small_batches(spark: SparkSession) -> None:
    """Bound what Arrow hands to a Python worker at once, as documents may be very long.

    The setting stays: Spark reads it when a plan runs, not when it is declared.
    """
    if int(spark.conf.get(BATCH_KEY)) > ROWS_PER_BATCH:
        spark.conf.set(BATCH_KEY, str(ROWS_PER_BATCH))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What runs in the block does so with this setting of the session."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
