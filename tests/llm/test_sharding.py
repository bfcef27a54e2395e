import random
import zlib
from collections import Counter, defaultdict

import pytest

from sparkloom.llm.sharding import cut_edges, place_large, quotas, shard_documents


def judge(found, shards, slack):
    loads, slots = Counter(), defaultdict(list)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    assert max(loads.values()) - min(loads[s] for s in range(shards)) <= slack
    return loads


def test_values_nulls_and_empty(docs, rows, empty):
    found = shard_documents(docs, shards=3).collect()
    wanted = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == wanted
    assert shard_documents(empty).collect() == []


def test_balance_and_groups(spark):
    rng = random.Random(1)
    data = []
    for i in range(6000):
        if i % 3 == 0:
            text = "hot copy " * 40  # a third of all rows
        elif i % 3 == 1:
            text = f"group {rng.randrange(400)} " * 30
        else:
            text = f"alone {i} " * rng.randrange(1, 60)
        data.append((i, text))
    found = shard_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert len(found) == 6000
    loads = judge(found, 24, max(r.size for r in found) * 2 + 24)
    text = dict(data)
    homes = defaultdict(set)
    for r in found:
        homes[text[r.doc_id]].add(r.shard)
    groups = [len(h) for t, h in homes.items() if t.startswith("group")]
    assert sum(n > 1 for n in groups) <= 0.1 * len(groups)
    assert len(homes["hot copy " * 40]) <= 24 and sum(loads.values()) == sum(r.size for r in found)
    again = shard_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(5)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in found}


def test_an_oversized_document_leaves_even_shards(spark):
    data = [(i, f"{i:03d} " * 20) for i in range(500)] + [(500, "x" * 100_000)]
    found = shard_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    own = next(r.shard for r in found if r.doc_id == 500)
    assert loads.pop(own) == 100_008 and len(loads) == 23
    assert max(loads.values()) - min(loads.values()) <= 2 * 88


@pytest.mark.parametrize("sizes, shards", [([5, 5, 5, 5], 4), ([100, 1, 1, 1], 2), ([100, 90, 1, 1, 1], 3), ([7], 3), ([50, 50, 50], 2), ([9, 8, 8, 1], 4)])
def test_quotas_against_brute_force(sizes, shards):
    """The even share is the smallest of the greatest loads that whole documents of their own allow."""
    own, quota = quotas(sizes[:shards], sum(sizes), shards)
    rest = sum(sizes) - sum(own)
    for k in range(min(shards - 1, len(sizes)) + 1):
        share = -(-(sum(sizes) - sum(sorted(sizes, reverse=True)[:k])) // (shards - k))
        if k < len(own):
            assert sorted(sizes, reverse=True)[k] * (shards - k) > sum(sizes) - sum(sorted(sizes, reverse=True)[:k])
        if k == len(own):
            assert share == quota == -(-rest // (shards - k))


def brute_cut(found, text):
    return sum(a.shard != b.shard for i, a in enumerate(found) for b in found[:i] if text[a.doc_id] == text[b.doc_id])


def test_groups_are_cut_only_where_they_must_be(spark):
    """Any group that fits into a shard is whole; one that doesn't fills as few shards as it can, all but the last."""
    rng = random.Random(8)
    data = [(i, ("large " * 50) if i < 300 else f"small {rng.randrange(150)} " * 20 if i < 900 else f"alone {i} " * rng.randrange(1, 9)) for i in range(1500)]
    found = shard_documents(spark.createDataFrame(data, "doc_id long, text string"), shards=8).collect()
    loads = judge(found, 8, 2 * max(r.size for r in found) + 8)
    text = dict(data)
    homes = defaultdict(Counter)
    for r in found:
        homes[text[r.doc_id]][r.shard] += 1
    large = homes["large " * 50]
    assert len(large) == -(-300 * 308 // max(loads.values()))
    assert sum(len(h) > 1 for t, h in homes.items() if t.startswith("small")) == 0
    edges = cut_edges(spark.createDataFrame([(r.text_crc32, r.size, r.shard) for r in found], "text_crc32 long, size long, shard int")).first()
    assert edges.edges == sum(len([1 for j, b in data[:i] if b == a]) for i, a in data)
    assert edges.cut == brute_cut(found, text)
    # no way to lay 300 copies over shards of this quota cuts fewer of their pairs
    most = max(loads.values()) // 308
    best = 300 * 299 // 2 - (300 // most) * most * (most - 1) // 2 - (300 % most) * (300 % most - 1) // 2
    assert edges.cut <= best * 1.1


def test_ids_null_or_equal_alone(spark):
    for name in (None, 7):
        data = [(name, f"text {i % 300} " * (1 + i % 5)) for i in range(1200)]
        found = shard_documents(spark.createDataFrame(data, "doc_id long, text string"), shards=6).collect()
        assert len(found) == 1200
        judge(found, 6, 4 * max(r.size for r in found))


def test_more_shards_than_documents(spark):
    found = shard_documents(spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "doc_id long, text string"), shards=24).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 3] and len({r.shard for r in found}) == 3


def test_large_groups_settle_in_the_driver():
    room = [100, 100, 100]
    assert place_large([(10, 4, [0, 4, 0]), (10, 15, [5, 5, 5])], room) == [[(1, 4)], [(0, 10), (1, 5)]] and room == [0, 10, 100]  # the larger group first
    assert place_large([(10, 50, [0, 0])], room := [30, 45]) == [[(1, 4), (0, 3)]]
