"""The prefix trie against plain Python, in one shard and in many."""

from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from vertexloom.llm.prefix_trie import Parentheses, prefix_trie, rebuilt, sequences

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, rebuild):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda t: t[:2])] for c, ts in turns.items()}
    if rebuild:
        h = {c: crc32(str(c).encode()) % 9 for c in own}
        base = {c: c - (abs(c) % 5) * (1 if c >= 0 else -1) for c in own}
        own = {c: own.get(base[c], [])[: h[c]] + own[c][h[c] :] for c in own}
    members, ends = {}, {}
    for c, seq in own.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    saved = {p: (len(m) - 1) * (len(p[-1][1].encode()) if p else 0) for p, m in members.items()}
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            sums[p[:d]] += saved[p]
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], sums[p],
            sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def nodes(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def conversations(seed, count, words, longest):
    """Few texts, so that many conversations share their first turns; copies, prefixes of others, single ones."""
    rng = np.random.default_rng(seed)
    out = []
    for c in range(count):
        for turn in range(rng.integers(1, longest + 1)):
            out.append((int(c * 3 - 20), int(turn), ["user", "bot"][turn % 2], words[int(rng.integers(len(words)) ** 2 / len(words))]))
    return out


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("turns_per_shard", [10**6, 60, 3])
def test_as_in_plain_python(spark, turns_per_shard, rebuild):
    rows = conversations(1, 120, ["", "a", "ä\U0001f600", "hello", "b"], 6)
    found = prefix_trie(table(spark, rows).repartition(5), rebuild, turns_per_shard)
    assert nodes(found) == plain(rows, rebuild)


def test_copies_run_through_shards(spark):
    hot = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    more = [(1000 + c, t, "user", f"turn {t}" if t < 5 - c % 3 else f"other {c % 7}") for c in range(60) for t in range(8)]
    short = [(2000 + c, 0, "user", "turn 0") for c in range(50)]
    rows = hot + more + short
    assert nodes(prefix_trie(table(spark, rows), turns_per_shard=40)) == plain(rows, False)


def test_nulls_ties_long_conversations_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 5, "user", "x"), (1, 2, None, "y"), (2, None, "", ""), (2, 2, "", "y" * 100_000)]
    rows += [(None, 1, "user", "of nobody"), (7, 1, "bot", "ab"), (8, 1, "bota", "b"), (9, 1, "bot", None)]
    rows += [(c, t, "user", "again and again") for c in (11, 12, 14) for t in range(30 + c)]
    frame = table(spark, rows).selectExpr("*", "1 AS family", "2 AS depth", "'z' AS key", "3 AS turns")
    assert nodes(prefix_trie(frame, turns_per_shard=40)) == plain(rows, False)
    twice = [(1, 1, "user", "same"), (1, 1, "user", "same"), (1, 1, "user", "else")]
    once = nodes(prefix_trie(table(spark, twice)))
    assert [r[1] for r in once] == [0, 1, 2, 3] and once == nodes(prefix_trie(table(spark, twice[::-1])))


def test_very_long_conversations(spark):
    rows = [(c, t, "user", "again") for c in (11, 12, 14) for t in range(2_000 + c)]
    found = {r["depth"]: r for r in prefix_trie(table(spark, rows), turns_per_shard=2_000).collect()}
    assert sorted(found) == list(range(2_015)) and found[0]["saved_tokens"] == 5 * (2 * 2_011 + 1)
    assert [found[d]["n_convs"] for d in (2_011, 2_012, 2_013, 2_014)] == [3, 2, 1, 1]


def test_turnless_and_no_conversations(spark):
    # conversation 8 has fewer turns than are taken from an absent family head
    assert crc32(b"8") % 9 > 1
    rows = [(8, 0, "user", "gone"), (10, 0, "user", "kept")]
    found = {r["conv_id"]: len(r["turns"]) for r in rebuilt(sequences(table(spark, rows))).collect()}
    assert found == {8: 0, 10: 1}
    assert nodes(prefix_trie(table(spark, rows), True)) == plain(rows, True)
    assert prefix_trie(table(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_find_close(seed):
    rng = np.random.default_rng(seed)
    steps, depth = [1], 1
    lean = [0.5, 0.8, 0.95][seed % 3]
    while len(steps) < 5_000 or depth > 1:
        up = rng.random() < (lean if len(steps) < 5_000 else 0) or depth == 1
        steps.append(1 if up else -1)
        depth += steps[-1]
    steps.append(-1)
    stack, closes = [], {}
    for i, step in enumerate(steps):
        if step == 1:
            stack.append(i)
        else:
            closes[stack.pop()] = i
    opens = np.array(sorted(closes))
    assert Parentheses(opens).find_close().tolist() == [closes[i] for i in opens.tolist()]
