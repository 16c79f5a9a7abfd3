"""The classifier with few labels, long texts and none to learn from."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from vertexloom.llm.common import fold
from vertexloom.llm.quality import THRESHOLD, classify, train


def made(seed, count, longest=200):
    rng = random.Random(seed)
    words = ["the", "river", "carries", "small", "boats", "to", "a", "market", "where", "people", "talk"]
    rows = []
    for i in range(count):
        n = rng.randint(20, longest)
        good = i % 5 != 0
        text = " ".join(rng.choice(words) for _ in range(n)) + "." if good else "".join(rng.choices("#@$%&0123456789 ", k=5 * n))
        rows.append((i, text, int(good)))
    return rows


@pytest.mark.parametrize("labelled", [60, 90])
def test_few_labels_are_enough(spark, labelled):
    rows = made(labelled, 400, 2_000)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows[:labelled]], "doc_id long, quality int")
    truth = dict((i, q) for i, _, q in rows)
    held = classify(docs, labels).where((F.col("row.doc_id") >= labelled) | (fold(F.col("row.doc_id"), 4) == 2)).collect()
    kept = {q: [r["quality_score"] >= THRESHOLD for r in held if truth[r["row"]["doc_id"]] == q] for q in (0, 1)}
    assert sum(kept[1]) >= 0.98 * len(kept[1]) and sum(kept[0]) <= 0.05 * len(kept[0])


def test_whole_texts_within_the_bound_are_learned_from(spark):
    rows = [(i, ("fine words here " * 10 if q else "") + "x9#" * 30 * (1 - q), q) for i, q in enumerate([1, 0] * 20)]
    rows += [(100, "fine words here " * 20_000, 1), (101, None, 1), (102, "", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    small = train(docs, labels, sample_bytes=2_000)
    assert small.trained and small.score("fine words here " * 10) > 0.7 > small.score("x9#" * 30)
    assert not train(docs, labels, sample_bytes=0).trained


@pytest.mark.parametrize("quality", [None, 0, 1])
def test_without_labels_of_both_kinds_all_stay(spark, tmp_path, quality):
    rows = made(3, 30)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, quality, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert {r["quality_score"] for r in classify(docs, labels).collect()} == {0.5}
    with pytest.warns(UserWarning, match="keeps all"):
        assert corpus_pipeline.keep_good(spark, docs, str(tmp_path)).count() == 30


def test_run_raises_where_a_stage_leaves_nothing(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "some text", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages = [("all go", lambda s, d, f: d.limit(0)), corpus_pipeline.STAGES[-1]]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    with pytest.raises(RuntimeError, match="all go rejects every document"):
        corpus_pipeline.run(spark, str(tmp_path))
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
