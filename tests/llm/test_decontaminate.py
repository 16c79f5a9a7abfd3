"""Benchmark windows against plain Python."""

import random
import re

import pytest

from vertexloom.llm.decontaminate import contamination, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    w, hit, met = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(10, len(b))
        windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                met.add(str(item))
    return len(w), len(hit), sorted(met)


@pytest.fixture(scope="module")
def case(awkward):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["été", "Straße"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(1, text(25)), (2, text(12)), (3, "just, four: Short Words"), (3, text(11)), (4, None), (5, "..."), (None, text(14))]
    rows = list(awkward)
    for i in range(40):
        parts = [text(rng.randint(0, 9)) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, rng.choice(items)[1] or "")
        rows.append((100 + i, ", ".join(parts), "s"))
    # hits at the ends of the pieces that long texts are cut into
    rows.append((200, " ".join(["z"] * 4_090) + " " + items[0][1] + " " + " ".join(["y"] * 70) + " " + items[1][1], "s"))
    return rows, items


def test_against_plain_python(spark, documents, case):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(documents(rows), bench).select("row.doc_id", "n_words", "n_hit", "items").collect()
    want = [(i, *plain(t, [("" if k is None else k, b) for k, b in items])) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert contamination(documents(rows), bench.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(documents(rows).limit(0), bench).count() == 0


def test_removal_of_documents_and_spans(spark, documents):
    item = " ".join(f"b{i}" for i in range(12))
    frame = documents([(1, f"Before, {item}! After it.", "s"), (2, "Clean; text.", "s")])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    whole = remove_contaminated(frame, bench)
    assert whole.columns == frame.columns and [r["doc_id"] for r in whole.collect()] == [2]
    cut = remove_contaminated(frame, bench, unit="span")
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "Before! After it.", 2: "Clean; text."}
