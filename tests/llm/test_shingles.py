import random

import corpus_pipeline
import pytest
import xxhash

from sparkloom.llm import shingles


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def expected(data):
    root = {i: i for i, _ in data}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(data):
        for j, b in data[:n]:
            if jaccard(a, b) >= 0.8:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in data}


def edited(seed, copies, bases):
    """Copies whose edits leave them on both sides of the limit, some of other lengths."""
    rng = random.Random(seed)
    data = []
    for _ in range(bases):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 160))]
        for _ in range(copies):
            words = base[rng.randrange(3) :]
            for _ in range(rng.randrange(1 + len(words) // 30)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            data.append((len(data), " ".join(words)))
    return data


@pytest.mark.parametrize("copies, bases", [(5, 40), (90, 2)])
def test_all_similar_pairs(spark, copies, bases):
    data = edited(copies, copies, bases)
    found = shingles.similar_documents(spark.createDataFrame(data, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == expected(data)


def test_stage_drops_copies_with_a_few_edits(spark, tmp_path):
    data = edited(7, 4, 30)
    spark.createDataFrame(data, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "d"))
    kept = dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, spark.read.parquet(str(tmp_path / "d")), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected(data).values()))


def brute_print(text):
    words = text.lower().split()
    grams = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_finds_links_and_the_rest_is_completed(spark, monkeypatch):
    data = edited(11, 4, 40)
    text = dict(data)
    df = spark.createDataFrame(data, "doc_id long, text string")
    prints = shingles.prefixes(df).cache()
    first = {r.node: r.doc_id for r in prints.where("fp IS NOT NULL").collect()}
    assert all(r.fp % (1 << 64) == brute_print(text[r.doc_id]) for r in prints.where("fp IS NOT NULL").collect())
    links = [(first[r.u], first[r.v]) for r in shingles.simhash_links(prints, df, shingles.SHINGLE, shingles.SIMILARITY).collect()]
    assert links and all(jaccard(text[a], text[b]) >= 0.8 for a, b in links)
    within = [(a, b) for a in first.values() for b in first.values() if a < b and jaccard(text[a], text[b]) >= 0.8 and (brute_print(text[a]) ^ brute_print(text[b])).bit_count() <= 3]
    root = expected([(i, t) for i, t in data if any(i in p for p in links)])
    assert within and all(root[a] == root[b] for a, b in within)

    asked = []
    verified = shingles._verified
    monkeypatch.setattr(shingles, "_verified", lambda pairs, *more: asked.append({(r.u, r.v) for r in pairs.collect()}) or verified(pairs, *more))
    assert {r.doc_id: r.component_id for r in shingles.similar_documents(df).collect()} == expected(data)
    assert len(asked[0]) >= len(links) and asked[1] and not asked[0] & asked[1]
