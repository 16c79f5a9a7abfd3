"""Groups of near copies against all pairs in plain Python."""

import random
import re
import time
from itertools import combinations

import numpy as np
import pytest

from vertexloom.llm import jaccard_join
from vertexloom.llm.common import BATCH_KEY, ROWS_PER_BATCH, SHUFFLE_CLEANUP_KEY
from vertexloom.llm.jaccard_join import (
    SKETCH_BITS,
    Shingler,
    connected,
    groups,
    may_be_similar,
    one_of_each,
    outline,
    parity,
    signatures,
    wide_parity,
)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(rows):
    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            label[root(j)] = root(i)
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    first = {}
    for i in range(len(rows)):
        first[root(i)] = min(first.get(root(i), key(i)), key(i))
    value = lambda k: None if k[0] else k[1]
    return [(rows[i][0], len(sets[i]), value(first[root(i)])) for i in range(len(rows))]


@pytest.fixture(scope="module")
def rows(awkward):
    rng = random.Random(9)
    text = lambda n: [f"t{rng.randint(0, 400)}" for _ in range(n)]
    made = list(awkward)
    common = text(60)
    for i in range(12):
        base = text(rng.randint(3, 120))
        for j in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 9)}"
            made.append((1000 + 10 * i + j, " ".join(copy), "s"))
    for i in range(30):  # a passage that many share, and near copies of it
        made.append((2000 + i, " ".join([*common, *text(rng.choice([0, 2, 4, 80]))]), "s"))
    return made


def test_against_all_pairs(documents, rows):
    got = groups(documents(rows)).select("doc_id", "n_shingles", "first.doc_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)
    assert groups(documents(rows).limit(0)).count() == 0


def test_one_of_each_group_stays(documents, rows):
    frame = documents(rows)
    kept = one_of_each(frame)
    assert kept.columns == frame.columns
    want = plain(rows)
    without_words = sum(n == 0 for _, n, _ in want)
    assert kept.count() == without_words + len({c for _, n, c in want if n})


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_similar_sets_share_a_signature(share):
    """Whatever tokens count as frequent, sets at the threshold meet."""
    rng = np.random.default_rng(int(share * 10))
    for n in [2, 3, 4, 5, 8, 13, 40, 120, 900]:
        for _ in range(8):
            frequent = np.packbits(rng.random(1 << 20) < share)
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            removed = rng.permutation(len(a))[: len(a) // 4]
            b = np.delete(a, removed)
            if 100 * len(b) >= 75 * len(a) and len(b) > 1 and len(b) < len(a):
                (left, reach), (right, other) = signatures(a, frequent), signatures(b, frequent)
                met = np.intersect1d(left, right)
                assert met.size
                # some shared signature reaches as far as what the sets have in common
                most = max(min(reach[left == s].max(), other[right == s].max()) for s in met)
                assert most * 175 >= (len(a) + len(b)) * 75
                assert may_be_similar(outline(a), outline(b), 75)


def test_words_of_different_texts_hash_apart():
    shingler = Shingler(1)
    found = shingler.words("ab ba abc a\tb c\x0bab ABC ä")
    assert len(set(found.tolist())) == 7 and found[0] == found[6] and found[2] == found[7]


def test_parities_never_part_similar_sets():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 400, 4_000):
        tokens = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        for shift in range(0, n, max(1, n // 7)):
            a, b = tokens[:n], tokens[shift : n + shift]
            differ = sum((x ^ y).bit_count() for x, y in zip(*[[v % 2**64 for v in parity(t)] for t in (a, b)], strict=True))
            assert differ <= 2 * shift and (differ > 0) == (shift > 0)
            wide = [wide_parity(t) for t in (a, b)]
            assert (wide[0] is None) == (n <= 256)
            if n > 256:
                differ = sum(((x ^ y) % 2**64).bit_count() for x, y in zip(*wide, strict=True))
                assert differ <= 2 * shift and 64 * len(wide[0]) >= 2 * n and differ >= min(shift, n // 4)


def test_large_sets_of_a_family(documents):
    """Sets that share most of one long passage, some of them just below the threshold."""
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(700)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.choice([3, 10, 18, 22, 30])):
            copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(copy), "s"))
    got = groups(documents(rows)).select("doc_id", "n_shingles", "first.doc_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)
    assert len({r[2] for r in plain(rows)}) > 1


def test_reach_bounds_what_is_shared():
    """At the first signature that two sets share, neither reach is below the size of their intersection."""
    rng = np.random.default_rng(9)
    frequent = np.packbits(np.arange(1 << SKETCH_BITS) % 2 == 0)
    for _ in range(300):
        n = int(rng.integers(8, 120))
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        base[rng.random(n) < 0.9] &= ~np.uint64(1)  # mostly frequent
        one, two = (np.unique(np.where(rng.random(n) < 0.06, rng.integers(0, 2**63, n).astype(np.uint64), base)) for _ in range(2))
        common = len(np.intersect1d(one, two))
        if 100 * common < 75 * (len(one) + len(two) - common):
            continue
        (s1, r1), (s2, r2) = signatures(one, frequent), signatures(two, frequent)
        shared, i, j = np.intersect1d(s1, s2, return_indices=True)
        assert len(one) == len(two) == common or (len(shared) and np.minimum(r1[i], r2[j]).max() >= common)


def test_links_are_gone_through_once_and_rounds_write_once(spark, documents, monkeypatch):
    tables, calls = [], []

    def stored(df, what, to=jaccard_join.stored):
        tables.append(what)
        return to(df, what)

    def counted(*args, f=jaccard_join.connected):
        calls.append(len(args))
        return f(*args)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    monkeypatch.setattr(jaccard_join, "connected", counted)
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join([*base[i % 3 :], f"x{i}"]), "s") for i in range(6)] + [(9, "of no group at all", "s")]
    got = groups(documents(rows)).select("doc_id", "n_shingles", "first.doc_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)
    assert len(calls) == 1  # no link came late, so nothing is linked again

    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 30)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    label = {n: n for pair in pairs for n in pair}
    while any(label[a] != label[b] for a, b in pairs):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    tables.clear()
    got = connected(spark.createDataFrame(pairs, "a long, b long"), len(pairs)).collect()
    assert sorted(map(tuple, got)) == sorted(label.items())
    # A path of 31 nodes took 1 table of links, 1 of first labels and then 2 a round.
    assert tables.count("links") == 1 and tables.count("labels") <= 8


def test_rows_of_numbers_go_in_large_batches_and_shuffles_go_with_their_step(spark, documents, monkeypatch):
    batches = {}

    def stored(df, what, to=jaccard_join.stored):
        batches[what] = int(spark.conf.get(BATCH_KEY))
        return to(df, what)

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return set(re.findall(r"shuffle_(\d+)_", blocks.mkString(" ")))

    monkeypatch.setattr(jaccard_join, "stored", stored)
    cleanup = spark.conf.get(SHUFFLE_CLEANUP_KEY)
    spark.conf.set(SHUFFLE_CLEANUP_KEY, "false")
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join([*base[i % 3 :], f"x{i}"]), "s") for i in range(6)] + [(9, "of no group at all", "s")]
    try:
        before = shuffles()
        found = groups(documents(rows))
        assert spark.conf.get(SHUFFLE_CLEANUP_KEY) == "false"
        until = time.time() + 20
        while (left := shuffles() - before) and time.time() < until:
            time.sleep(0.2)
        assert not left
        got = found.select("doc_id", "n_shingles", "first.doc_id").collect()
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_KEY, cleanup)
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)
    texts = {"shingle-sets", "likely-pairs", "links", "texts-of-pairs"}
    assert max(batches[what] for what in texts) <= ROWS_PER_BATCH == int(spark.conf.get(BATCH_KEY))
    assert batches["shared-signatures"] > 10_000


def test_tables_between_have_few_files_under_a_wide_shuffle(spark, documents, monkeypatch):
    """Files go by rows, as every file costs a task and commands that set its permissions."""
    files = {}

    def stored(df, what, to=jaccard_join.stored):
        out = to(df, what)
        files[what] = max(files.get(what, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rng = random.Random(5)
    rows = [(None, "", "s"), (-1, "of no group at all", "s")]
    for i in range(40):
        base = [f"b{rng.randrange(10**6)}" for _ in range(40)]
        rows += [(10 * i + j, " ".join([*base[j % 2 :], f"x{i} {j}"]), "s") for j in range(3)]
    common = [f"c{i}" for i in range(60)]
    rows += [(1000 + i, " ".join([*common, *[f"e{i} {k}" for k in range(i % 9)]]), "s") for i in range(40)]
    wide = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in wide}
    try:
        for key, value in wide.items():
            spark.conf.set(key, value)
        found = groups(documents(rows)).select("doc_id", "n_shingles", "first.doc_id")
        assert found.rdd.getNumPartitions() <= 4
        assert sorted(map(tuple, found.collect()), key=str) == sorted(plain(rows), key=str)
        between = set(files) - {"shingle-sets"}  # that has the partitions of the input
        assert len(between) > 8 and max(files[what] for what in between) <= 4
        monkeypatch.setattr(jaccard_join, "NUMBERS_PER_FILE", 100)
        monkeypatch.setattr(jaccard_join, "TEXTS_PER_FILE", 10)
        got = groups(documents(rows)).select("doc_id", "n_shingles", "first.doc_id").collect()
        assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)
        assert min(files["shared-signatures"], files["classes"]) > 8  # more for more rows
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
