"""Mixing against a plain walk through the slots."""

from fractions import Fraction

import pytest

from vertexloom.llm.mixing import mix, period, phases, tempered_weights


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 97}, {"a": 7, "b": 6, "c": 4, "d": 1}])
def test_shares_stay_within_one_block_at_every_slot(weights):
    slots, total = period(weights), sum(weights.values())
    assert sorted(x for s in slots.values() for x in s) == list(range(total))
    for source, n in weights.items():
        for t in range(total + 1):
            assert abs(sum(x < t for x in slots[source]) - Fraction(n * t, total)) < 1
        for k, slot in enumerate(slots[source], 1):
            assert (k - 1) * total // n <= slot < -(-k * total // n)


def walked(weights, docs, block):
    """Order of (source, rank) by taking blocks slot by slot."""
    left, order = dict(docs), []
    rank = dict.fromkeys(docs, 0)
    while any(left.values()):
        active = {s: weights[s] for s in weights if left.get(s)}
        by_slot = {x: s for s, xs in period(active).items() for x in xs}
        slot = 0
        while all(left[s] for s in active):
            s = by_slot[slot % sum(active.values())]
            for _ in range(min(block, left[s])):
                rank[s] += 1
                left[s] -= 1
                order.append((s, rank[s]))
            slot += 1
    return order


def test_places_follow_the_walk(documents):
    sizes, weights = {"a": 37, "b": 10, "c": 3}, {"a": 5, "b": 3, "c": 2}
    rows = [(1000 * k + i, f"text {i}", s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    got = mix(documents(rows), weights, block_docs=2).orderBy("mix_position").collect()
    assert [r["mix_position"] for r in got] == list(range(50))
    want = walked(weights, sizes, 2)
    assert [r["source"] for r in got] == [s for s, _ in want]
    assert [(r["source"], r["mix_block"]) for r in got] == [(s, (k - 1) // 2 + 1) for s, k in want]
    assert phases(weights, sizes, 2)[-1]["weights"] == {"a": 5}


def test_awkward_rows_all_get_a_place(documents, awkward):
    frame = documents(awkward)
    got = mix(frame, in_order=True)
    assert set(frame.columns) <= set(got.columns)
    assert sorted(r["mix_position"] for r in got.collect()) == list(range(len(awkward)))
    assert mix(frame, {"a": 2}).count() == len(awkward)
    assert mix(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mix(frame, {"a": 0})


def test_any_number_of_sources(documents):
    sizes = {f"d{i:04d}.org": 2 + i % 3 for i in range(1_200)} | {"big": 900, "odd": 77}
    rows = [(10_000 * k + i, f"text {k} {i}", s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    given = mix(documents(rows, extra=False), {s: 1 + n for s, n in sizes.items()}, resolution=10)
    assert sorted(r["mix_position"] for r in given.select("mix_position").collect()) == list(range(len(rows)))
    # without weights, each source keeps near its share of roots while all of its kind go on
    got = mix(documents(rows, extra=False), block_docs=2).orderBy("mix_position").collect()
    assert [r["mix_position"] for r in got] == list(range(len(rows)))
    assert {r["doc_id"] for r in got} == {i for i, _, _ in rows}
    total = sum(n**0.5 for n in sizes.values())
    seen = sum(r["source"] == "big" for r in got[:900])
    assert abs(seen - 900 * 30 / total) < 4
    small = [r["source"] for r in got[:900] if r["source"] not in ("big", "odd")]
    assert max(small.count(s) for s in set(small)) <= 3


def test_small_sources_keep_their_share():
    weights = tempered_weights({"large": 10**8, "small": 100})
    assert abs(weights["small"] / sum(weights.values()) * 1_001 - 1) < 0.1
