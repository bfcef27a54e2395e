"""Token counts by a finite-state transducer compiled from a byte-level BPE tokenizer's merges.

Compilation. Let t(i) be the last token of a word's first i bytes, and n(i) their number of tokens. A byte-pair
encoding is the encoding of what its last token leaves, plus that token; t(i) is therefore the one token that ends at i
and may follow t at the place where it begins. Two tokens may follow one another unless a merge across their border
comes before those that build them. So all that the bytes read so far have to say is, for each place from which a token
may still be under way: where in the vocabulary's trie it is, the last token before that place, and how many tokens have
been emitted since. That is the state. Its arcs read one byte each and are annotated with the tokens that they emit net
(an arc that lengthens the last token emits none or less). States are finite in number and are numbered as they are met,
like those of a lazily determinised automaton; arcs of whole words are composed from them and kept.

The pre-tokeniser is a second, small automaton over character classes: ``\\s``, letters, numbers, others and contractions.
It never joins a visible character with white space behind it, so each such edge resets the transducer: a chunk of a
text has the same inner arcs whatever state it is entered in. Its state map is (head, emitted, tail): what is left open
at either end, and the tokens between. Maps compose associatively, and a text's are combined pairwise, as a prefix scan
does. The tokenizer's own library isn't used here; tests hold counts against it.

Defined results: a null text counts as empty (0 bytes, 0 tokens); lone rows, repeated rows and any length count alike;
an empty table gives no rows. Extra columns are ignored. A tokenizer of another kind raises ValueError.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import hold, spread

WHITE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
IS_WHITE = re.compile(f"[{WHITE}]")
CHUNK = 1 << 16
#: Composed arcs kept a worker, of words and of what the pre-tokeniser makes of them, and byte arcs. Beyond it they are
#: compiled anew: a memory bound, without effect on results.
MAX_ARCS = 400_000
MAX_BYTE_ARCS = 2_000_000
LONG_UNIT = 200
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
START = -1
#: Letters and numbers of Unicode 16, which the tokenizers' library follows, that Python's own tables may not have yet.
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
LATER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]


def _bytes_of_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class StateMap(NamedTuple):
    """What a chunk does. closed: it holds a reset, so that ``tail`` is apart from ``head``."""

    head: str
    emitted: int = 0
    tail: str = ""
    closed: bool = False


class Words:
    """The pre-tokeniser: a deterministic automaton over character classes that says where words begin.

    Classes: L letter, N number, O other, S the space character, W other white space. It is fed with units: white space,
    then visible characters (either may be missing). The last space before visible characters belongs to them.
    """

    def __init__(self) -> None:
        self.seen: dict[str, str] = {" ": "S"} | {chr(c): k for k, ranges in (("L", LATER_LETTERS), ("N", LATER_NUMBERS)) for low, high in ranges for c in range(low, high + 1)}

    def kind(self, c: str) -> str:
        found = self.seen.get(c)
        if found is None:
            found = self.seen[c] = "W" if IS_WHITE.match(c) else k if (k := unicodedata.category(c)[0]) in "LN" else "O"
        return found

    def of(self, unit: str) -> list[str]:
        kinds = [*map(self.kind, unit)]
        n, at = len(unit), 0
        while at < n and kinds[at] in "SW":
            at += 1
        out: list[str] = []
        if at == n:
            return [unit] if unit else []
        begin = at
        if at:
            if at > 1:
                out.append(unit[: at - 1])
            if kinds[at - 1] == "S":
                begin = at - 1
            else:
                out.append(unit[at - 1 : at])
        while at < n:
            end = at + 1
            if unit[at] == "'" and begin == at and (c := next((c for c in CONTRACTIONS if unit.startswith(c, at)), None)):
                end = at + len(c)
            else:
                while end < n and kinds[end] == kinds[at]:
                    end += 1
            out.append(unit[begin:end])
            begin = at = end
        return out


class TokenTransducer:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model, pre = parts["model"], parts["pre_tokenizer"] or {}
        plain = not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges") or parts["normalizer"])
        if model["type"] != "BPE" or not plain or PRE_TOKENIZER.items() - pre.items():
            raise ValueError(f"{path} is no byte-level BPE with the usual pre-tokeniser")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take in what is beside them")
        letters, vocab = _bytes_of_letters(), model["vocab"]
        added = {t["content"] for t in parts["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        #: Rank of the merge of two tokens, and its outcome.
        self.rank: dict[tuple[int, int], int] = {}
        #: The merge that makes a token: its rank (bytes: -1) and parts.
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if (left, right) not in self.rank:
                self.rank[left, right] = rank
                self.made.setdefault(whole, (rank, left, right))
        self.trie: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        self.inner: set[int] = set()
        nodes = 1
        for token, number in vocab.items():
            if token in added:
                continue
            at = 0
            for c in token:
                key = at << 8 | letters[c]
                self.inner.add(at)
                at = self.trie.get(key, 0)
                if not at:
                    at = self.trie[key] = nodes
                    nodes += 1
            self.ends[at] = number
        missing = [b for b in range(256) if b not in self.trie]
        if missing:
            raise ValueError(f"{path} has no token for the bytes {missing[:5]}")
        self.words = Words()
        self.units: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.follows: dict[tuple[int, int], bool] = {}
        start = ((0, START, 0),)
        self.states: list[tuple] = [start]
        self.numbers: dict[tuple, int] = {start: 0}
        #: For each state, by byte: the next state and the tokens that the arc emits net.
        self.arcs: list[dict[int, tuple[int, int]]] = [{}]
        self.compiled = 0

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """(token, rank of the merge that makes it) from a token up to the byte at one of its edges."""
        out = [(token, -1)]
        while (made := self.made.get(out[-1][0])) is not None:
            out[-1] = (out[-1][0], made[0])
            out.append((made[2 if right else 1], -1))
        return out

    def _apart(self, left: int, right: int, below: int) -> bool:
        """Whether no merge of a rank below ``below`` crosses the border before the next one on either side does."""
        a, b = self._edge(left, True), self._edge(right, False)
        while True:  # from the bytes at the border to the whole tokens
            next_a, next_b = (e[-2][1] if len(e) > 1 else below for e in (a, b))
            across = self.rank.get((a[-1][0], b[-1][0]), below)
            if across < next_a and across <= next_b and across < below:  # of equal merges the left one comes first
                return False
            if len(a) == len(b) == 1:
                return True
            (a if len(a) > 1 and next_a <= next_b or len(b) == 1 else b).pop()

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart beside one another."""
        known = self.follows.get((left, right))
        if known is None:
            known = self.follows[left, right] = self._apart(left, right, len(self.rank))
        return known

    def _whole(self, token: int) -> bool:
        """Whether a token's own bytes are encoded as that token."""
        known = self.follows.get((token, START))
        if known is None:
            rank, left, right = self.made.get(token, (0, START, START))
            known = self.follows[token, START] = token not in self.made or self._whole(left) and self._whole(right) and self._apart(left, right, rank)
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The arc from a state by a byte."""
        moved, last, net = [], None, 0
        for node, before, emitted in self.states[state]:
            to = self.trie.get(node << 8 | byte)
            if to is None:
                continue
            moved.append((to, before, emitted))
            token = self.ends.get(to)
            if token is not None and last is None and self._whole(token) and (before == START or self.may_follow(before, token)):
                last, net = token, 1 - emitted
        target = tuple((to, before, emitted + net) for to, before, emitted in moved if to in self.inner) + ((0, last, 0),)
        number = self.numbers.get(target)
        if number is None:
            number = self.numbers[target] = len(self.states)
            self.states.append(target)
            self.arcs.append({})
        self.compiled += 1
        arc = self.arcs[state][byte] = (number, net)
        return arc

    def run(self, word: bytes) -> int:
        """Tokens that a word emits from the start state."""
        arcs, state, total = self.arcs, 0, 0
        for byte in word:
            arc = arcs[state].get(byte)
            state, net = arc if arc is not None else self._compile(state, byte)
            total += net
        return total

    def _piece(self, piece: str) -> int:
        found = self.pieces.get(piece)
        if found is None:
            found = self.run(piece.encode())
            if len(piece) <= LONG_UNIT:
                self.pieces[piece] = found
        return found

    def _unit(self, unit: str) -> int:
        """Tokens of a whole unit. Added tokens in it are one each, and what is beside them is parted there."""
        parts = self.special.split(unit) if self.special else [unit]
        return len(parts) - 1 + sum(self._piece(p) for part in parts for p in self.words.of(part))

    def emitted(self, units: list[str]) -> int:
        """Tokens that a run of whole units emits."""
        known = self.units
        try:
            return sum(map(known.__getitem__, units))
        except KeyError:
            pass
        if len(known) > MAX_ARCS:
            known.clear()
        if len(self.pieces) > MAX_ARCS:
            self.pieces.clear()
        if self.compiled > MAX_BYTE_ARCS:
            self._forget()
        found = {u: self._unit(u) for u in set(units).difference(known)}
        total = sum(known[u] if u in known else found[u] for u in units)
        known.update((u, n) for u, n in found.items() if len(u) <= LONG_UNIT)
        return total

    def state_map(self, chunk: str) -> StateMap:
        units = UNIT.findall(chunk)
        if len(units) < 2:
            return StateMap(chunk)
        return StateMap(units[0], self.emitted(units[1:-1]), units[-1], True)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if not a.closed and not b.closed:
            return StateMap(a.head + b.head)
        if not a.closed:
            return StateMap(a.head + b.head, b.emitted, b.tail, True)
        if not b.closed:
            return StateMap(a.head, a.emitted, a.tail + b.head, True)
        return StateMap(a.head, a.emitted + self.emitted(UNIT.findall(a.tail + b.head)) + b.emitted, b.tail, True)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if len(text) <= chunk:
            return self.emitted(UNIT.findall(text))
        maps = [self.state_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            paired = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = paired + maps[len(paired) * 2 :]
        whole = maps[0]
        return self.emitted(UNIT.findall(whole.head)) + whole.emitted + self.emitted(UNIT.findall(whole.tail))


@lru_cache(maxsize=4)
def transducer(path: str) -> TokenTransducer:
    """One a worker and tokenizer."""
    return TokenTransducer(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens). A map over the scan: no shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("tokencount", transducer.cache_clear)
        t = transducer(tokenizer_path)
        for batch in batches:
            texts = batch.column(1)
            n_bytes = [0 if not v.is_valid else v.as_buffer().size for v in texts]
            tokens = [t.count(v.as_py() or "") for v in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return spread(source).mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
