"""Links of near duplicates inside hubs that best ties leave open."""

import random

import numpy as np
import pyarrow as pa
import pytest

from aerolake.llm import jaccard_join
from aerolake.llm.jaccard_join import forest, linked

from .conftest import frame


def components(n, links):
    part = list(range(n))
    for i, j in links:
        part = [part[i] if p == part[j] else p for p in part]
    return [part.index(p) for p in part]


@pytest.mark.parametrize("seed", range(6))
def test_forest_joins_what_all_pairs_join(seed):
    rng = random.Random(seed)
    bases = [rng.sample(range(10**9), 40) for _ in range(4)]
    sets = []
    for _ in range(60):
        own = set(rng.choice(bases))
        for _ in range(rng.randrange(8)):
            own.discard(rng.choice(sorted(own)))
            own.add(rng.randrange(10**9))
        sets.append(np.array(sorted(own), np.uint64))
    start = np.array([rng.randrange(30) for _ in sets])
    found = forest(sets, start)
    pairs = [(i, j) for i in range(60) for j in range(i) if linked(sets[i], sets[j])]
    same = [(i, j) for i in range(60) for j in range(i) if start[i] == start[j]]
    assert components(60, same + found) == components(60, same + pairs)
    assert all(linked(sets[i], sets[j]) for i, j in found)
    assert len(found) <= len(set(start.tolist())) - 1


def test_a_block_of_near_copies_gives_a_tree():
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(np.concatenate((base, np.array([1_000 + i], np.uint64)))) for i in range(300)]
    assert len(forest(sets, np.arange(300))) == 299


def test_sketch_step_gives_no_more_rows_than_it_gets():
    n = 200
    sketch = jaccard_join._sketch([np.arange(1 << 30, (1 << 30) + 500, dtype=np.uint64) << np.uint64(12)] * n)
    rows = pa.table(
        {
            "node": pa.array(range(n), pa.int64()),
            "component": pa.array(range(n), pa.int64()),
            "size": pa.array([500] * n, pa.int64()),
            "sketch": pa.array(sketch, pa.binary()),
        }
    )
    found = jaccard_join._near((pa.scalar(7), pa.scalar(0, pa.int32()), pa.scalar(0, pa.int32())), rows)
    assert len(found) == n and found["hub"].to_pylist() == [7] * n


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_near_copies_without_doc_id_are_found(spark):
    rng = random.Random(3)
    a, b, c = words(rng, 80), words(rng, 80), words(rng, 80)
    near = [a[:40] + ["changed"] + a[41:], b[:1] + ["new"] + b[2:]]
    rows = [(None, a), (None, near[0]), (5, b), (None, near[1]), (None, c), (9, c)]
    docs = frame(spark, [(d, " ".join(t)) for d, t in rows])
    found = {(r["doc_id"], r["component_id"], r["component"]) for r in jaccard_join.join(docs).collect()}
    assert len({c for *_, c in found}) == 3
    assert {(d, i) for d, i, _ in found if d is not None} == {(5, 5), (9, 9)}
    assert jaccard_join.one_of_each(docs).count() == 3


@pytest.mark.parametrize("block", [3, 1_000])
def test_chains_and_groups_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(11)
    shared = words(rng, 60)
    rows = []
    for group in range(4):
        text = shared[:30] + words(rng, 60)
        for i in range(12):
            rows.append((group * 100 + i, " ".join(text)))
            at = rng.randrange(30, 90)
            text = text[:at] + words(rng, 1) + text[at + 1 :]
    docs = [t.split() for _, t in rows]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in docs]
    pairs = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    part = components(len(rows), pairs)
    least = {p: min(rows[i][0] for i in range(len(rows)) if part[i] == p) for p in set(part)}
    expected = sorted((rows[i][0], least[part[i]]) for i in range(len(rows)))
    found = jaccard_join.join(frame(spark, rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == expected


def packed(rng, copies, buckets):
    """Near copies as the tie step gets them, by bucket; and the texts of each key."""
    base = [rng.randrange(1 << 62) for _ in range(60)]
    packs, members = {}, {}
    for node in range(copies):
        keys = [rng.randrange(1 << 62) if rng.random() < 0.5 else k for k in base]
        for b in range(buckets):
            own = np.array([k for k in keys if k % buckets == b], "<u8")
            head = np.array([1, len(own)], "<u8").tobytes() + np.array([node], "<i8").tobytes()
            packs.setdefault(b, []).append(head + own.tobytes() + np.zeros(len(own), "<u2").tobytes())
        for k in keys:
            members.setdefault(k, set()).add(node)
    return packs, members


def test_ties_are_not_repeated_for_each_hub_of_a_group():
    packs, members = packed(random.Random(5), 400, 2)
    ties = []
    for own in packs.values():
        for out in jaccard_join._tie(iter([pa.RecordBatch.from_pydict({"pack": pa.array(own, pa.binary())})])):
            ties += zip(out["node"].to_pylist(), out["hub"].to_pylist(), strict=True)
    assert len(ties) <= 2 * 1.2 * 400  # nearly as many for each of several hubs before
    hubs = {n: {n} for n in range(400)}
    for node, hub in ties:
        hubs[node].add(hub)
    # the texts of each key still meet somewhere
    assert all(set.intersection(*[hubs[n] for n in own]) for own in members.values())


def test_few_signatures_make_few_buckets(spark, monkeypatch):
    seen = []
    deal = jaccard_join._deal
    monkeypatch.setattr(jaccard_join, "_deal", lambda buckets: seen.append(buckets) or deal(buckets))
    rows = [(i, " ".join(words(random.Random(i // 2), 40))) for i in range(20)]
    found = jaccard_join.join(frame(spark, rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == [(i, i // 2 * 2) for i in range(20)]
    assert seen == [1]
