import sys
from pathlib import Path

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkloom.llm.tokencount import TokenTransducer, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = TokenTransducer(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


PIECES = st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", "\n", "\t ", "\r\n", " ", " ", "\x85", "\x1c", "'s", "'ll", "<|endoftext|>", "<|endof", "é", "é", "日本", "123", "!?"])), max_size=25)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 9))
def test_whole_and_chunked_counts_equal_the_library(pieces, chunk):
    text = "".join(pieces)
    assert OWN.count(text) == library(text)
    assert OWN.count(text, chunk) == library(text)


def test_every_row(docs, rows):
    found = sorted(map(tuple, count_tokens(docs, PATH).collect()), key=str)
    wanted = sorted(((i, len((t or "").encode()), library(t), library(t) > 1024) for i, t, _, _ in rows), key=str)
    assert found == wanted


def test_long_runs_and_empty_table(empty):
    for text in ("x" * 200_000, " " * 70_000 + "a", "ab " * 60_000, "\n" * 140_000):
        assert OWN.count(text, 1 << 14) == library(text)
    assert count_tokens(empty, PATH).collect() == []


def test_classes_follow_the_library():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "\n".join("a" + c for c in points)
    spans = {span for _, span in LIBRARY.pre_tokenizer.pre_tokenize_str(text)}
    letters = {c for i, c in enumerate(points) if (3 * i, 3 * i + 2) in spans}
    assert letters == {c for c in points if OWN.words.kind(c) == "L"}


def test_the_library_is_not_used():
    source = Path(sys.modules[TokenTransducer.__module__].__file__).read_text()
    assert "tokenizers import" not in source and "import tokenizers" not in source


@settings(max_examples=200, deadline=None)
@given(st.text("abcdefgehn ing't", max_size=40))
def test_words_of_few_letters(text):
    assert OWN.count(text) == library(text)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        TokenTransducer(public_tokenizers.path("word_bpe_49k.json"))
