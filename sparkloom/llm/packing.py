"""Packing by lexical retrieval: BM25 neighbours fill a seed document's window.

Documents are tokenised once, and their ids written down with the counts of documents that hold each term. Weights are of
the whole corpus: its document frequencies and its mean length. Each document is sent where its two leading terms lead,
so that copies and documents alike come to lie in one shard, side by side; a term that leads many documents is parted by
adaptive execution. Terms lead by how often they stand in the document and by their place in the vocabulary, which lists
what is frequent in any language first: that needs no pass of its own, and finds neighbours better than the heaviest
terms by BM25 do. A shard, of
bounded size, has an inverted index of BM25 weights over token ids. Window by window, the shard's first unused document,
in the input's order, is the seed: all its distinct terms query the index, and the best unused neighbours follow it until the window is full. The
document at a window's end is cut there, and what is left of it seeds the next. Windows run on across a task's shards, so
only a task's last window can be short.

Defined results: a null text is empty and gives its end id alone; repeated rows are packed each; a text of any length
is cut freely; ties go to the earlier document; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, repeat
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import give_back, hold, materialize, passing_tables

WINDOW = 4096
END_ID = 2
K1, B = 1.2, 0.75
#: Neighbours are looked at in blocks of so many, best first, until the window is full.
LOOK = 32
#: A term is common if one of so many documents of a shard holds it.
DENSE = 8
#: Tokens of a shard, about. One document may be longer; it then is a shard of its own.
SHARD_TOKENS = 1 << 21
#: Words a worker remembers. Beyond them those that it met longest ago go, down to KEPT_WORDS.
MAX_WORDS, KEPT_WORDS = 700_000, 525_000
#: Units laid out, words encoded and bytes of text taken at once: they bound what a task needs beside its caches.
UNITS_AT_ONCE, WORDS_AT_ONCE, TEXT_AT_ONCE = 1 << 17, 1 << 15, 4 << 20
#: After so many of these texts a task gives freed memory back.
GIVE_BACK_EACH = 4
LONG_UNIT = 200
#: What often follows a word, none of it a letter, digit or apostrophe.
ENDINGS = ".,;:!?*#$%&()[]|\"-"
#: Which bytes are ASCII letters or digits, and which are lower-case ASCII letters.
ALNUM, LOWER = (np.array([c < 128 and chr(c).isalnum() for c in range(256)]), np.array([97 <= c <= 122 for c in range(256)]))


def laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column."""
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    kind = np.dtype(np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    _, offsets, data = column.buffers()
    return np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind.itemsize), np.frombuffer(data or b"", np.uint8)


def spans(cuts: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes of ``data`` between each cut and the next."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


class UnitTokenizer:
    """Ids of whole texts, from those of their ASCII-space-separated units, which the tokenizer never joins.

    A unit is a word with what follows it: the tokenizer cuts between a letter or digit and punctuation, so words and
    their endings are looked up apart. Upper-case ASCII is lowered first, as the tokenizer does, save where a special
    token's string could come of it. Units and words are told apart and joined as Arrow columns; only a column's
    distinct words meet the dictionary of those remembered, and only new ones the tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # words and endings remembered, in order: their places in ``found``, and the column that last had each
        self.units: dict[bytes, int] = {b"": 0}
        self.found = pa.array([b""], pa.large_binary())
        self.used, self.column = np.zeros(1, np.int64), 0
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        # the same model for words that normalising and splitting leave as they are
        spaces = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        suffix = parts["model"].get("end_of_word_suffix")
        self.plain = Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "pre_tokenizer": spaces, "post_processor": None, "added_tokens": []})) if suffix else None
        top = max([*parts["model"]["vocab"].values(), *(t["id"] for t in parts["added_tokens"]), END_ID])
        self.vocabulary = top + 1
        self.kind = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.ends_word = np.zeros(max(parts["model"]["vocab"].values()) + 1, bool)
        self.ends_word[[i for token, i in parts["model"]["vocab"].items() if suffix and token.endswith(suffix)]] = True
        del parts
        give_back()

    def ids(self, text: str | None, end: int | None = END_ID) -> np.ndarray:
        return next(self.each([text], end))

    def each(self, texts: Iterable[str | None], end: int | None = END_ID) -> Iterator[np.ndarray]:
        """Ids of every text."""
        return (np.frombuffer(raw, self.kind) for raw in self.raw(texts, end))

    def raw(self, texts: Iterable[str | None], end: int | None = END_ID) -> Iterator[bytes]:
        """Ids as bytes of ``kind``."""
        return self.encoded(pa.array(texts, pa.string()), end)

    def encoded(self, texts: pa.Array, end: int | None = END_ID) -> Iterator[bytes]:
        """Ids of an Arrow column's texts. Units are split and numbered in Arrow, and looked up once a column."""
        tail = b"" if end is None else np.array([end], self.kind).tobytes()
        texts = texts.fill_null("")
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(lowered)
        numbered = split.flatten().cast(pa.binary()).dictionary_encode()
        own = self._units(numbered.dictionary)
        words = numbered.indices
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        ends = np.concatenate([[0], np.cumsum(np.diff(laid_out(own)[0])[words.to_numpy(zero_copy_only=False)])])[edges].tolist()  # of each text's ids, in bytes
        doc, held, at = 0, [], 0
        for k in range(0, max(1, len(words)), UNITS_AT_ONCE):
            cuts, data = laid_out(own.take(words.slice(k, UNITS_AT_ONCE)))
            held.append(data[cuts[0] : cuts[-1]])
            have = at + sum(map(len, held))
            if doc < len(texts) and ends[doc + 1] <= have:
                flat = b"".join(held)
                while doc < len(texts) and ends[doc + 1] <= have:
                    yield flat[ends[doc] - at : ends[doc + 1] - at] + tail
                    doc += 1
                held, at = [flat[ends[doc] - at :]], ends[doc]

    def _units(self, units: pa.Array) -> pa.Array:
        """Ids of distinct units: those of each one's word, then those of what follows it."""
        trimmed = pc.ascii_rtrim(units.view(pa.string()), ENDINGS).cast(pa.binary())
        cuts, data = laid_out(units)
        begins, n, word = cuts[:-1].astype(np.int64), np.diff(cuts), np.diff(laid_out(trimmed)[0])
        apart = word > 0
        apart[apart] = ALNUM[data[(begins + word)[apart] - 1]]
        word = np.where(apart, word, n)
        rest_cuts = np.concatenate([[0], np.cumsum(n - word)])
        rests = data[np.repeat(begins + word - rest_cuts[:-1], n - word) + np.arange(rest_cuts[-1])]
        parts = pa.concat_arrays([pc.if_else(pa.array(apart), trimmed, units), spans(rest_cuts, rests).cast(pa.binary())]).dictionary_encode()
        found = self._words(parts.dictionary)
        return pc.binary_join_element_wise(found.take(parts.indices[: len(units)]), found.take(parts.indices[len(units) :]), pa.scalar(b"", pa.large_binary()))

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words and endings, which are remembered unless they are long."""
        keys = words.to_numpy(zero_copy_only=False).tolist()  # bytes, far faster than to_pylist
        places = np.fromiter(map(self.units.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(places < 0)
        self.column += 1
        self.used[places[places >= 0]] = self.column
        if not len(new):
            return self.found.take(pa.array(places))
        fresh = words.take(pa.array(new))
        ids = self._encode(fresh)
        places[new] = len(self.found) + np.arange(len(new))
        result = pa.concat_arrays([self.found, ids]).take(pa.array(places))
        short = np.diff(laid_out(fresh)[0]) <= LONG_UNIT
        self._remember([keys[k] for k in new[short].tolist()], ids.filter(pa.array(short)))
        return result

    def _remember(self, keys: list[bytes], ids: pa.Array) -> None:
        self.units.update(zip(keys, range(len(self.found), len(self.found) + len(keys))))
        self.found = pa.concat_arrays([self.found, ids])
        self.used = np.concatenate([self.used, np.full(len(keys), self.column)])
        if len(self.units) > MAX_WORDS:
            self.used[0] = self.column  # the empty word stays first
            keep = np.zeros(len(self.used), bool)
            keep[np.argsort(-self.used, kind="stable")[:KEPT_WORDS]] = True
            kept = list(compress(self.units, keep.tolist()))
            self.units.clear()  # the old table goes before the new one is made
            self.units.update(zip(kept, range(KEPT_WORDS)))
            self.found, self.used = self.found.filter(pa.array(keep)), self.used[keep]

    def _encode(self, words: pa.Array) -> pa.Array:
        """Ids of words: of lower-case Latin letters alone by the plain model, of all others by the library itself."""
        cuts, data = laid_out(words)
        ascii = np.diff(np.concatenate([[0], np.cumsum(~LOWER[data])])[cuts]) == 0 if self.plain else np.zeros(len(words), bool)
        rows, other = [np.flatnonzero(ascii)], np.flatnonzero(~ascii)
        plain: list[str] = []
        plain_rows: list[int] = []
        rest: list[bytes] = []
        rest_rows: list[int] = []
        for k, w in zip(other.tolist(), words.take(pa.array(other)).to_numpy(zero_copy_only=False).tolist()):
            if self.plain and (t := w.decode("utf-8", "surrogatepass").lower()).isalpha() and max(t) < "\u0250":
                plain.append(t)
                plain_rows.append(k)
            else:
                rest.append(w)
                rest_rows.append(k)
        letters = words.take(pa.array(rows[0])).view(pa.string())
        found = [pa.array([], pa.large_binary())]
        for at in range(0, len(letters), WORDS_AT_ONCE):
            own = letters.slice(at, WORDS_AT_ONCE)
            found.append(self._plain_ids(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), " ")[0].as_py(), len(own)))
        for at in range(0, len(plain), WORDS_AT_ONCE):
            own = plain[at : at + WORDS_AT_ONCE]
            found.append(self._plain_ids(" ".join(own), len(own)))
        found.extend(self._parted(rest[at : at + WORDS_AT_ONCE]) for at in range(0, len(rest), WORDS_AT_ONCE))
        place = np.empty(len(words), np.int64)
        place[np.concatenate([*rows, np.array(plain_rows, np.int64), np.array(rest_rows, np.int64)])] = np.arange(len(words))
        return pa.concat_arrays(found).take(pa.array(place))

    def _plain_ids(self, text: str, words: int) -> pa.Array:
        """Ids of each of a text's words, by the plain model: each ends with a token that ends words."""
        (encoded,) = self.plain.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(encoded.ids, self.kind)
        cuts = np.concatenate([[0], np.flatnonzero(self.ends_word[ids]) + 1])
        if len(cuts) != words + 1:
            raise ValueError(f"{len(cuts) - 1} words found of {words}")
        return spans(cuts * ids.itemsize, ids)

    def _parted(self, words: list[bytes]) -> pa.Array:
        """Ids of each word, from one text where spaces part them; its tokens' offsets tell whose they are."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        encoded = self.library.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(encoded.ids, self.kind)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        offsets = np.fromiter(map(itemgetter(0), encoded.offsets), np.int64, len(ids))
        return spans(np.searchsorted(offsets, begins) * ids.itemsize, ids)


@lru_cache(maxsize=4)
def unit_tokenizer(path: str) -> UnitTokenizer:
    return UnitTokenizer(path)


def terms_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids, ascending, and how often each occurs."""
    own = np.sort(ids, kind="stable")
    edges = np.ones(len(own) + 1, bool)
    np.not_equal(own[1:], own[:-1], out=edges[1:-1])
    edges = np.flatnonzero(edges) if len(own) else np.zeros(1, np.int64)
    return own[edges[:-1]].astype(np.int64), edges[1:] - edges[:-1]


def leading(terms: np.ndarray, counts: np.ndarray, rarity: np.ndarray) -> tuple[int, int]:
    """The two terms that lead a document, -1 for a missing one."""
    weights = rarity[terms] * (counts / (counts + K1))
    first = int(weights.argmax())
    if len(terms) == 1:
        return int(terms[first]), -1
    weights[first] = -1.0
    return int(terms[first]), int(terms[weights.argmax()])


class Corpus(NamedTuple):
    """What BM25 asks of the whole corpus: documents that hold each term, documents, and their mean length."""

    df: np.ndarray
    documents: int
    mean: float

    def weights(self, terms: np.ndarray, counts: np.ndarray, length: np.ndarray | float) -> np.ndarray:
        """BM25 weights of terms in documents of these lengths."""
        df = self.df[terms]
        norm = K1 * (1 - B + B * length / self.mean)
        return (np.log1p((self.documents - df + 0.5) / (df + 0.5)) * counts * (K1 + 1) / (counts + norm)).astype(np.float32)


def corpus_of(docs: list[np.ndarray], vocabulary: int) -> Corpus:
    """The statistics of documents at hand."""
    df = np.zeros(vocabulary, np.int64)
    for ids in docs:
        df[terms_of(ids)[0]] += 1
    return Corpus(df, len(docs), max(1.0, sum(map(len, docs)) / max(1, len(docs))))


class Bm25Shard:
    """Inverted index of a shard's documents: for each term, the documents that have it and their weights."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None) -> None:
        terms, counts = zip(*map(terms_of, docs)) if docs else ((), ())
        self.ends = np.cumsum([len(t) for t in terms])
        self.n = len(docs)
        self.term = np.concatenate(terms) if docs else np.empty(0, np.int64)
        tf = np.concatenate(counts) if docs else np.empty(0, np.int64)
        owner = np.repeat(np.arange(self.n), [len(t) for t in terms])
        length = np.array([len(d) for d in docs], np.float32)
        space = int(self.term.max()) + 1 if len(self.term) else 0
        corpus = corpus or corpus_of(docs, space)
        weight = corpus.weights(self.term, tf, length[owner]) if docs else np.empty(0, np.float32)
        df = np.bincount(self.term, minlength=space)
        # terms that many documents hold are a matrix, the others postings: the same sums, each in its cheaper form
        common = np.flatnonzero(df * DENSE >= self.n) if self.n > DENSE else np.empty(0, np.int64)
        self.row = np.full(space, -1)
        self.row[common] = np.arange(len(common))
        row = self.row[self.term]
        self.dense = np.zeros((len(common), self.n), np.float32)
        self.dense[row[row >= 0], owner[row >= 0]] = weight[row >= 0]
        rare = row < 0
        term, owner, weight = self.term[rare], owner[rare], weight[rare]
        order = np.argsort(term.astype(np.uint16) if space <= 1 << 16 else term, kind="stable")
        self.posting_doc, self.posting_weight = owner[order], weight[order].astype(np.float64)
        self.starts = np.r_[0, np.cumsum(np.bincount(term, minlength=space))]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document of the shard for all distinct terms of the seed."""
        terms = self.term[(self.ends[seed - 1] if seed else 0) : self.ends[seed]]
        rows = self.row[terms]
        asked = np.zeros(len(self.dense), np.float32)
        asked[rows[rows >= 0]] = 1
        runs = [slice(a, b) for a, b in zip(self.starts[terms].tolist(), self.starts[terms + 1].tolist()) if b > a]
        found = np.bincount(np.concatenate([self.posting_doc[r] for r in runs]), np.concatenate([self.posting_weight[r] for r in runs]), self.n) if runs else np.zeros(self.n)
        return found + asked @ self.dense


class Packer:
    """Windows of one task. ``pieces`` rows: doc, start, length, crc32, doc tokens, sequence, offset."""

    def __init__(self, first_sequence: int, window: int = WINDOW) -> None:
        self.window, self.sequence, self.used = window, first_sequence, 0
        self.pieces: list[tuple] = []

    def room(self) -> int:
        return self.window - self.used

    def put(self, doc: object, ids: np.ndarray, start: int) -> int:
        """Place what fits of ``ids[start:]``; the number of ids placed."""
        take = min(self.room(), len(ids) - start)
        self.pieces.append((doc, start, take, zlib.crc32(ids[start : start + take].astype("<u4").tobytes()), len(ids), self.sequence, self.used))
        self.used += take
        if self.used == self.window:
            self.sequence, self.used = self.sequence + 1, 0
        return take

    def shard(self, docs: list[tuple[object, np.ndarray]], corpus: Corpus | None = None) -> list[tuple]:
        index = Bm25Shard([ids for _, ids in docs], corpus)
        free = np.ones(len(docs), bool)
        seed, start, ahead = -1, 0, 0
        while True:
            if seed < 0:
                while ahead < len(docs) and not free[ahead]:
                    ahead += 1
                if ahead == len(docs):
                    break
                seed, start = ahead, 0
            free[seed] = False
            name, ids = docs[seed]
            while start < len(ids):
                start += self.put(name, ids, start)
            seed = self._neighbours(index, docs, free, seed) if self.used else (-1, 0)
            seed, start = seed
        done, self.pieces = self.pieces, []
        return done

    def _neighbours(self, index: Bm25Shard, docs: list[tuple[object, np.ndarray]], free: np.ndarray, seed: int) -> tuple[int, int]:
        """Fill the open window with the seed's unused neighbours. What is left of the last of them, as the next seed."""
        scores = np.where(free, np.round(index.scores(seed), 4), -1.0)  # so that equal texts tie
        look = LOOK
        while True:
            best = np.argpartition(-scores, look - 1)[:look] if look < len(scores) else np.arange(len(scores))
            for k in best[np.lexsort((best, -scores[best]))]:
                if scores[k] <= 0:
                    return -1, 0
                name, ids = docs[k]
                took = self.put(name, ids, 0)
                free[k], scores[k] = False, -1.0
                if took < len(ids):
                    return int(k), took
                if not self.used:
                    return -1, 0
            if look >= len(scores):
                return -1, 0
            look *= 4


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Beside the terms, whose numbers are their ids: documents and tokens.
DOCUMENTS, TOKENS = -1, -2


def by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where their texts (second column) exceed TEXT_AT_ONCE bytes; a longer text is alone.

    What the parts' consumer has freed is given back to the system after every GIVE_BACK_EACH of them.
    """
    parts = 0
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(total[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + TEXT_AT_ONCE, side="right")))
            yield batch.slice(at, end - at)
            at, parts = end, parts + 1
            if parts % GIVE_BACK_EACH == 0:
                give_back()


def tokenized(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (two or four bytes each) and leading terms; and of each task a row with the counts of what it saw (terms, counts)."""
    schema = f"first int, second int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, terms array<int>, counts array<long>"
    names = ["first", "second", "doc_id", "ids", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("packing", unit_tokenizer.cache_clear)
        tokenizer = unit_tokenizer(tokenizer_path)
        df = np.zeros(tokenizer.vocabulary, np.int64)
        rarity = np.square(np.arange(tokenizer.vocabulary) / tokenizer.vocabulary)
        n = tokens = 0
        id_type = None
        for batch in by_size(batches):
            id_type = batch.schema.field(0).type
            found, leads = [], []
            for raw in tokenizer.encoded(batch.column(1)):
                ids = np.frombuffer(raw, tokenizer.kind)
                terms, counts = terms_of(ids)
                df[terms] += 1
                leads.append(leading(terms, counts, rarity))
                tokens += len(ids)
                found.append(raw)
            n += len(found)
            first, second = zip(*leads) if leads else ((), ())
            nothing = [pa.nulls(len(found), pa.list_(pa.int32())), pa.nulls(len(found), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), batch.column(0), pa.array(found, pa.binary()), *nothing], names)
            del found, leads, nothing
        if n:
            terms = np.flatnonzero(df)
            counted = [pa.array([np.r_[DOCUMENTS, TOKENS, terms].astype(np.int32)], pa.list_(pa.int32())), pa.array([np.r_[n, tokens, df[terms]]], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, id_type), pa.nulls(1, pa.binary()), *counted], names)
        give_back()

    return docs.mapInArrow(run, schema)


def corpus_statistics(ids: DataFrame, vocabulary: int) -> Corpus:
    """Sums of the tasks' counts: a number a term comes to the driver."""
    each = ids.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("x.terms", "x.counts")
    found = each.groupBy("terms").agg(F.sum("counts").alias("n")).toArrow()
    terms, n = (found.column(k).to_numpy().astype(np.int64) for k in ("terms", "n"))
    total = dict(zip(terms.tolist(), n.tolist()))
    df = np.zeros(vocabulary, np.int64)
    df[terms[terms >= 0]] = n[terms >= 0]
    documents = total.get(DOCUMENTS, 0)
    return Corpus(df, documents, max(1.0, total.get(TOKENS, 0) / max(1, documents)))


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Texts aren't shuffled; ids are, once, by their document's leading terms.
    """
    tokenizer = unit_tokenizer(tokenizer_path)
    vocabulary, kind = tokenizer.vocabulary, tokenizer.kind
    with passing_tables() as kept:
        source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        ids = materialize(tokenized(source, tokenizer_path).withColumn("row", F.monotonically_increasing_id()), "ids", kept)
    corpus = docs.sparkSession.sparkContext.broadcast(corpus_statistics(ids, vocabulary))
    id_type = ids.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("packing", unit_tokenizer.cache_clear)
        context = TaskContext.get()
        packer = Packer((context.partitionId() if context else 0) << 40, window)
        gathered, tokens, arrow_type = [], 0, None

        def emit() -> pa.RecordBatch:
            gathered.sort(key=itemgetter(0))
            columns = list(zip(*packer.shard([g[1:] for g in gathered], corpus.value))) or [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], arrow_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["doc_id", *(x.split()[0] for x in PIECES.split(", "))],
            )

        for batch in batches:
            arrow_type = batch.schema.field(0).type
            for name, raw, row in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                own = np.frombuffer(raw.as_buffer(), kind).copy()
                gathered.append((row, name.as_py(), own))
                tokens += len(own)
                if tokens >= shard_tokens:
                    yield emit()
                    gathered, tokens = [], 0
        if gathered:
            yield emit()
        gathered = []
        give_back()

    near = ids.where("ids IS NOT NULL").select("first", "second", "doc_id", "ids", "row").hint("rebalance", "first").sortWithinPartitions("first", "second")
    return near.select("doc_id", "ids", "row").mapInArrow(pack, f"doc_id {id_type}, {PIECES}")
