"""The registered queries of this subpackage and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vertexloom.llm.centroids import clustered
from vertexloom.llm.common import fold, hex_sha256, table
from vertexloom.llm.decontaminate import contamination
from vertexloom.llm.jaccard_join import groups
from vertexloom.llm.line_dedup import dedup_lines
from vertexloom.llm.markov import score_texts
from vertexloom.llm.mixing import mix
from vertexloom.llm.packing import packed, pieces
from vertexloom.llm.page_text import extract
from vertexloom.llm.prefix_trie import prefix_trie
from vertexloom.llm.private_data import KINDS, find_private_data
from vertexloom.llm.quality import THRESHOLD, classify
from vertexloom.llm.queries_sql import ORACLES
from vertexloom.llm.secrets import BASE_RULES, find_secrets
from vertexloom.llm.spans import span_list
from vertexloom.llm.top_k import top_k


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", "mix_position", "mix_phase", "mix_slot", "mix_block")


def op2_markov_score(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents").select("doc_id", "text"))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [
        F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in ("assign", "access", "hex")
    ]
    base = span_list(F.col("found"), [r.kind for r in BASE_RULES])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *counts,
        hex_sha256(base).alias("base_sha256"),
        span_list(F.col("found")).alias("spans"),
    )


def op4_private_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_private_data(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [
        F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in KINDS
    ]
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *counts,
        hex_sha256(span_list(F.col("found"), KINDS)).alias("base_sha256"),
        span_list(F.col("found")).alias("spans"),
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", hex_sha256(F.col("text")).alias("kept_sha256")
    )


def op6_page_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select(
        F.col("row.page_id").alias("page_id"),
        F.col("row.url").alias("url"),
        "text",
        F.char_length("text").cast("long").alias("n_chars"),
    )


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, folder, "benchmark").select("item_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        hex_sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = classify(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        (fold(F.col("row.doc_id"), 4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"), rebuild=True)


def op12_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed(cut.select(F.col("row.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32"))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found = clustered(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.select(
        F.col("row.vec_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_markov_score": op2_markov_score,
        "op3_secret_scan": op3_secret_scan,
        "op4_private_data": op4_private_data,
        "op5_line_dedup": op5_line_dedup,
        "op6_page_text": op6_page_text,
        "op7_decontaminate": op7_decontaminate,
        "op8_top_k": op8_top_k,
        "op9_quality": op9_quality,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_best_fit_packing": op12_best_fit_packing,
        "op13_centroids": op13_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
