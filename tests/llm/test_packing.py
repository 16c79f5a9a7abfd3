"""Packing: ids against the tokenizer library, places against the rules, the search against brute force."""

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vertexloom.llm import packing
from vertexloom.llm.packing import Encoder, best_fit, bin_completion, fewest, fillings, pack

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "aB's re\n\t\x1c\x85\xa0éÉßǰJ̌̈Σς²5½İ漢\U0001f600–…'LL_- \r\nªµ×÷ÿŸ<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet=ODD, max_size=30)), max_size=4))
def test_ids_are_those_of_the_library(encoder, library, texts):
    assert [ids(x) for x in encoder.encode(texts)] == [library(t) for t in texts]


def test_ids_of_long_texts_and_of_a_full_store(library, monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 50)
    monkeypatch.setattr(packing, "WORDS_HELD", 400)
    monkeypatch.setattr(packing, "STRETCH", 1000)
    rng = np.random.default_rng(3)
    words = ["word", "Über", "x" * 90, "it's", "42nd", "漢字", "e.g."] + [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choice(words, n)) for n in (5, 900, 0, 3000, 40)] + [None, "", "x" * 100_000]
    assert [ids(x) for x in Encoder(PATH).encode(texts)] == [library(t or "") for t in texts]


def whole(counts, packing_, capacity):
    got = Counter()
    for pattern, number in packing_:
        assert number > 0 and sum(length * n for length, n in pattern) <= capacity
        for length, n in pattern:
            got[length] += n * number
    assert got == +counts
    return sum(number for _, number in packing_)


def histogram(counts, capacity):
    out = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        out[length] = n
    return out


def fewest_by_trying(items, capacity):
    """Exact: sequences of what is left after the largest piece took each possible company."""
    items = tuple(sorted(items, reverse=True))
    best = {(): 0}

    def solve(left):
        if left not in best:
            rest, found = left[1:], len(left)
            for n in range(len(rest) + 1):
                for company in set(combinations(rest, n)):
                    if left[0] + sum(company) <= capacity:
                        after = list(rest)
                        for x in company:
                            after.remove(x)
                        found = min(found, 1 + solve(tuple(after)))
            best[left] = found
        return best[left]

    return solve(items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_search_finds_the_fewest(items):
    counts = Counter(items)
    found, bound = bin_completion(counts, 20)
    assert whole(counts, found, 20) == fewest_by_trying(items, 20) >= bound


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200), st.integers(1, 10_000))
def test_every_incumbent_is_whole(items, times):
    counts = Counter({length: n * times for length, n in Counter(items).items()})
    found, bound = bin_completion(counts, 100, work=20)
    plain = best_fit(histogram(counts, 100), 100)
    assert bound == fewest(histogram(counts, 100), 100) <= whole(counts, found, 100) <= whole(counts, plain, 100)


def test_search_beats_best_fit():
    counts = Counter(np.random.default_rng(0).integers(20, 60, 60).tolist())
    plain, (found, bound) = best_fit(histogram(counts, 100), 100), bin_completion(counts, 100)
    assert (whole(counts, plain, 100), whole(counts, found, 100), bound) == (25, 24, 24)
    larger = Counter({k: v * 10**9 for k, v in counts.items()})
    assert 24 * 10**9 <= whole(larger, bin_completion(larger, 100)[0], 100) < 24.2 * 10**9


def test_fillings_are_undominated():
    counts = histogram(Counter([6, 5, 4, 3, 3, 2]), 10)
    found = fillings(counts, [2, 3, 4, 5, 6], 8)
    assert all(sum(x * n for x, n in f) == 8 for f in found) and ((6, 1), (2, 1)) in found
    assert fillings(counts, [2, 3, 4, 5, 6], 6) == [((6, 1),)]
    assert fillings(counts, [2, 3, 4, 5, 6], 1) == [()]


def check(rows, texts, library, capacity, column="ids"):
    """All pieces of all documents, in sequences without gaps or overlaps."""
    by_sequence, by_document = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_document.setdefault(r["row"]["copy"], []).append(r)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    assert len(by_document) == len(texts)
    for copy, text in enumerate(texts):
        wanted = library(text or "") + [1]
        parts = sorted(by_document[copy], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(wanted) // capacity)))
        for r in parts:
            own = wanted[r["start"] : r["start"] + r["length"]]
            assert r["start"] == capacity * r["piece"] and ids(r[column]) == own
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    return len(by_sequence)


def test_pack(spark, library, documents, awkward):
    rng = np.random.default_rng(1)
    texts = [t for _, t, _ in awkward] + [" ".join(rng.choice(["ab", "Cd", "e,"], n)) for n in rng.integers(0, 300, 60)]
    texts += ["one of many copies"] * 50
    rows = [(i, t, str(i)) for i, t in enumerate(texts)]
    frame = documents(rows).selectExpr("*", "doc_id AS copy", "7 AS piece", "8 AS length", "9 AS _row").drop("doc_id")
    frame = frame.withColumn("doc_id", F.expr("nullif(copy, 3)")).repartition(5)
    found = pack(frame, PATH, capacity=64, with_ids=True).collect()
    lengths = Counter(r["length"] for r in found)
    assert check(found, texts, library, 64) <= fewest(histogram(lengths, 64), 64) * 1.01 + 1


def test_repeated_rows_and_no_rows(spark, documents):
    same = documents([(1, "the same text", "a")] * 40)
    found = pack(same, PATH, capacity=10).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 40 and len({r["sequence_id"] for r in found}) == 20
    assert pack(documents([]), PATH).count() == 0
