import random
from collections import Counter
from pathlib import Path

import numpy as np
import xxhash

from sparkloom.llm.common import drop_tables, tables
from sparkloom.llm.simhash import REACH, linked_roots, near_duplicates, near_links

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= REACH:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [brute_print(t) for _, t, *_ in rows]
    roots = brute_components(prints)
    low = {}
    for (i, *_), r in zip(rows, roots):
        if i is not None and (low.get(r) is None or i < low[r]):
            low[r] = i
    return Counter((i, f"{p:016x}", low.get(r)) for (i, *_), p, r in zip(rows, prints, roots))


def test_against_brute_force(docs, rows, empty):
    assert Counter(map(tuple, near_duplicates(docs).collect())) == expected(rows)
    assert near_duplicates(empty).collect() == []


def test_chains_of_edited_copies(spark):
    rng = random.Random(5)
    data, base = [], [f"w{rng.randrange(900)}" for _ in range(400)]
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(50)}"
        data.append((i, " ".join(words) if i % 3 else " ".join(f"z{rng.randrange(5000)}" for _ in range(40))))
    found = near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == expected(data)


def test_large_groups_split_exactly():
    rng = np.random.default_rng(2)
    centers = rng.integers(0, 2**64, 6, dtype=np.uint64)
    fps = {int(c) for c in centers}
    while len(fps) < 2600:
        x = int(rng.choice(list(centers)))
        for _ in range(int(rng.integers(1, 9))):
            x ^= 1 << int(rng.integers(0, 64))
        fps.add(x)
    own = np.array(sorted(fps), np.uint64)
    roots = linked_roots(own)
    near = np.bitwise_count(own[:, None] ^ own[None, :]) <= REACH
    want = np.arange(len(own))
    while True:
        low = np.where(near, want[None, :], len(own)).min(axis=1)
        if (low == want).all():
            break
        want = low
    assert (roots == want).all()


def test_hot_keys_are_cut_exactly(spark):
    """All fingerprints share their upper half, so that eight tables have one key for all of them."""
    rng = np.random.default_rng(6)
    fps, top = set(), 0xABCDEF01 << 32
    while len(fps) < 400:
        x = top | int(rng.integers(0, 2**32))
        fps.add(x)
        for _ in range(4):
            x ^= 1 << int(rng.integers(0, 32))
            x ^= 1 << int(rng.integers(0, 32))
            fps.add(x)
    own = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in own.view(np.int64)], "fp long")
    roots = brute_components([int(x) for x in own])
    want = {(int(own[i].view(np.int64)), int(own[r].view(np.int64))) for i, r in enumerate(roots)}
    for hot in (50, 10**6):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for r in near_links(df, hot).collect():
            assert (r.u ^ r.v).bit_count() <= 64
            root[find(r.u)] = find(r.v)
        groups = {}
        for a, b in want:
            groups.setdefault(b, set()).add(find(a))
        assert all(len(g) == 1 for g in groups.values()) and len({find(a) for a, _ in want}) == len(groups)


def test_a_fingerprint_with_a_third_of_all_rows(spark):
    data = [(i if i % 7 else None, "one two three four" if i % 3 == 0 else f"w{i} x{i} y{i}") for i in range(900)]
    found = near_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == expected(data)


def test_nothing_is_left_after_a_run(spark, docs, tmp_path):
    before = tables()
    near_duplicates(docs).collect()
    left = tables() - before
    assert all(p.rsplit("/", 1)[1] in {"prints", "owned"} for p in left)
    drop_tables(left)
    assert tables() == before and not any(Path(p).exists() for p in left)
