import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkloom.llm import packing
from sparkloom.llm.packing import END_ID, Bm25Shard, UnitTokenizer, corpus_of, corpus_statistics, pack_documents, tokenized

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = UnitTokenizer(PATH)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [END_ID]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "\n", "\x1c", "\x85", " ", "é", " ́", "'s", "<|endoftext|>", "<|startoftext|>x", "İ", "ΟΔΟΣ", "12", "!?"])), max_size=20))
def test_ids_equal_the_library(pieces):
    text = "".join(pieces)
    assert OWN.ids(text).tolist() == library(text)


def check(found, rows, window=4096):
    ids = {i: np.array(library(t), "<u4") for i, t, *_ in rows}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    copies = defaultdict(int)
    for i, *_ in rows:
        copies[i] += 1
    for i, own in pieces.items():
        covered = np.zeros(len(ids[i]), int)
        for start, length in own:
            covered[start : start + length] += 1
        assert (covered == copies[i]).all()
    assert set(pieces) == set(ids)
    return windows


def test_every_id_once_and_windows_full(spark, docs, rows, empty):
    windows = check(pack_documents(docs.coalesce(1), PATH, window=64).collect(), rows, 64)
    assert sum(sum(n for _, n in w) < 64 for w in windows.values()) <= 1
    check(pack_documents(docs, PATH).collect(), rows)
    check(pack_documents(docs.coalesce(1), PATH, window=64, shard_tokens=50).collect(), rows, 64)
    assert pack_documents(empty, PATH).collect() == []


def test_bm25_scores():
    docs = [np.array(d, np.uint32) for d in ([1, 2, 2, 3], [2, 3], [4, 5, 6, 6], [1, 1, 1])]
    index = Bm25Shard(docs)
    n, mean = 4, np.mean([len(d) for d in docs])

    def weight(term, d):
        df = sum(term in x for x in docs)
        tf = int((d == term).sum())
        return np.log1p((n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))

    for s, seed in enumerate(docs):
        want = [sum(weight(t, d) for t in np.unique(seed)) for d in docs]
        assert np.allclose(index.scores(s), want, atol=1e-5)


def test_neighbours_share_a_window(spark):
    topics = [" ".join(f"{a}{b}x" for b in "abcdefgh") for a in ("red", "blue", "green")]
    data = [(k * 10 + i, topics[k]) for i in range(4) for k in range(3)]
    found = pack_documents(spark.createDataFrame(data, "doc_id long, text string").coalesce(1), PATH, window=4 * len(library(topics[0])) + 3).collect()
    first = {r.doc_id // 10 for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)) if r.sequence_id == 0 and r.start == 0}
    ordered = [r.doc_id // 10 for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)) if r.sequence_id == 0][:4]
    assert 0 in first and ordered == [0] * 4


def test_all_terms_of_a_long_seed_query():
    seed = np.arange(200, dtype=np.uint32)
    docs = [seed, *(np.array([t, 500 + t], np.uint32) for t in range(200))]
    assert (Bm25Shard(docs).scores(0) > 0).all()


def test_common_and_rare_terms_score_alike():
    """More documents than DENSE: the matrix and the postings together give every document's full score."""
    rng = np.random.default_rng(4)
    docs = [np.r_[np.arange(5), rng.integers(5, 400, rng.integers(1, 30))].astype(np.uint16) for _ in range(60)]
    corpus = corpus_of(docs, 400)
    index = Bm25Shard(docs, corpus)
    assert len(index.dense) >= 5 and len(index.posting_doc)
    for s in range(0, 60, 7):
        want = [sum(float(corpus.weights(np.array([t]), np.array([(d == t).sum()]), float(len(d)))[0]) for t in np.unique(docs[s]) if (d == t).any()) for d in docs]
        assert np.allclose(index.scores(s), want, atol=1e-4)


def test_statistics_are_the_whole_tables(spark):
    data = [(i, f"shared only{i % 7} " * (i % 5)) for i in range(50)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    found = corpus_statistics(tokenized(df, PATH), OWN.vocabulary)
    want = corpus_of([OWN.ids(t) for _, t in data], OWN.vocabulary)
    assert (found.df == want.df).all() and found.documents == 50 and found.mean == want.mean


def test_copies_meet_in_a_shard(spark):
    """Copies far apart in the input, shards far smaller than it: nearly all share a window or the next."""
    rng = np.random.default_rng(1)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(150)]
    df = spark.createDataFrame([(i, texts[i % 150]) for i in range(300)], "doc_id long, text string").repartition(3)
    first = {r.doc_id: r.sequence_id for r in pack_documents(df, PATH, window=512, shard_tokens=4000).where("start = 0").collect()}
    assert sum(abs(first[i] - first[i + 150]) <= 1 for i in range(150)) >= 140


def test_new_words_are_encoded_in_bounded_parts(monkeypatch):
    """A batch of new words isn't handed to the library at once; ids stay those of whole texts, and long units aren't kept."""
    monkeypatch.setattr(packing, "WORDS_AT_ONCE", 3, raising=False)
    monkeypatch.setattr(packing, "UNITS_AT_ONCE", 4)
    own, sizes = UnitTokenizer(PATH), []
    parted = own._parted
    monkeypatch.setattr(own, "_parted", lambda words: sizes.append(len(words)) or parted(words))
    texts = [" ".join(f"{w}{i} {w}{'xyz'[i % 3]}, größe{w} 日本{i}!" for i in range(9)) for w in ("one", "Two", "l" * 250)] + [None, ""]
    assert [x.tolist() for x in own.each(texts)] == [library(t) for t in texts]
    assert [x.tolist() for x in own.each(texts[::-1])] == [library(t) for t in texts[::-1]]
    assert len(sizes) > 3 and max(sizes) <= 3
    assert not [u for u in own.units if len(u) > packing.LONG_UNIT]


def test_memory_is_given_back_during_a_task(monkeypatch):
    monkeypatch.setattr(packing, "TEXT_AT_ONCE", 10)
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * 8] * 9)], ["doc_id", "text"])
    parts = list(packing.by_size(iter([batch, batch])))
    assert [p.num_rows for p in parts] == [1] * 18
    assert len(given) == 18 // packing.GIVE_BACK_EACH


def test_words_in_use_are_encoded_once(monkeypatch):
    """Words that keep coming, with other endings each time, outlast those that don't, and ids stay the library's."""
    monkeypatch.setattr(packing, "MAX_WORDS", 60)
    monkeypatch.setattr(packing, "KEPT_WORDS", 40, raising=False)
    own, seen = UnitTokenizer(PATH), []
    encode = own._encode
    monkeypatch.setattr(own, "_encode", lambda words: seen.extend(w if isinstance(w, bytes) else w.as_py() for w in words) or encode(words))
    often = ["steady", "größe", "日本", "it's", "x1"]
    for k, ending in enumerate(["", ".", ",", "!?", ";", ":", "...", '"']):
        texts = [" ".join([*(w + ending for w in often), *(f"{'abcdefgh'[k]}{a}{b}" for a in "klmnop" for b in "aeiou")]), None, "", " .. " + ending]
        assert [x.tolist() for x in own.each(texts)] == [library(t) for t in texts]
    assert len(set(seen)) > 200
    assert [w for w in often if seen.count(w.encode()) != 1] == []
    assert len(own.units) <= 60


def test_forgetting_needs_no_second_table(monkeypatch):
    monkeypatch.setattr(packing, "MAX_WORDS", 70_000)
    monkeypatch.setattr(packing, "KEPT_WORDS", 52_500)
    tokenizer = UnitTokenizer(PATH)
    tokenizer._remember([b"%d" % k for k in range(69_999)], packing.spans(np.arange(70_000) * 0, np.empty(0, np.uint8)))
    before = tokenizer.units
    tokenizer._remember([b"new"], packing.spans(np.zeros(2), np.empty(0, np.uint8)))
    assert tokenizer.units is before and len(before) == 52_500
    assert list(before.items())[:2] == [(b"", 0), (b"0", 1)] and set(before.values()) == set(range(52_500))
