from collections import defaultdict

import pytest

from sparkloom.llm.mixing import mix_sources


def brute_targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check(result, total_rows):
    assert len(result) == total_rows
    assert all(0 <= r.taken <= 2 * r.size for r in result)


def test_targets_and_taken(spark, docs, rows):
    found = mix_sources(docs).collect()
    check(found, len(rows))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    by_id = {}
    for i, text, _, source in rows:
        size = len((text or "").encode().split())
        sizes[source] += size
        largest[source] = max(largest[source], size)
        by_id.setdefault(i, set()).add((size, source))
    target = brute_targets(sizes)
    for r in found:
        size, source = next(iter(by_id[r.doc_id]))
        assert (r.size, r.source_size) == (size, sizes[source])
        assert r.target == pytest.approx(target[source])
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6


def test_many_documents_come_near_their_target(spark):
    import random

    rng = random.Random(3)
    data = [(i, "w " * int(rng.paretovariate(1.1) * 5), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(4000)]
    found = mix_sources(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    check(found, 4000)
    again = mix_sources(spark.createDataFrame(data[::-1], "doc_id long, text string, source string").repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    source = {i: s for i, _, s in data}
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
    sizes = defaultdict(int)
    for r in found:
        sizes[source[r.doc_id]] += r.size
    for s, t in brute_targets(sizes).items():
        assert target[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= largest[s] * 1.01 + 0.01 * t


def test_empty_table(empty):
    assert mix_sources(empty).collect() == []


def test_all_sizes_zero(spark):
    found = mix_sources(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in found} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
