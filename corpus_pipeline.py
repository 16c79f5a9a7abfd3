"""From raw documents to a mixed training corpus, in five stages.

Each stage takes all that the stage before kept, written as Parquet and read again, and
returns a DataFrame with the columns of ``documents``; the last one adds the place of
each document in the mixture.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm import common, decontaminate, jaccard_join, line_dedup, mixing, quality
from vertexloom.runtime import use_local_scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; all, with a warning, if no labels teach it."""
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    if not model.trained:
        warnings.warn("no documents with labels of both kinds: the quality classifier keeps all", stacklevel=2)
        return docs
    found = quality.scored(docs, model)
    return found.where(F.col("quality_score") >= quality.THRESHOLD).select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many documents share; ``n_chars`` follows the text."""
    found = line_dedup.dedup_lines(docs)
    text = F.when(F.col("n_dropped") > 0, F.col("text")).otherwise(F.col("row.text"))
    chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return found.select(F.col("row").withField("text", text).withField("n_chars", chars).alias("row")).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixture, with its place."""
    return mixing.mix(docs, in_order=True)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

#: A learned classifier comes first, so SQL cannot give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; raises if one of them leaves nothing of something.

    An empty table stays empty. See the operators for nulls, repeated rows and ties.
    """
    use_local_scratch(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if kept.isEmpty() and not docs.isEmpty():
            raise RuntimeError(f"{name} rejects every document")
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
