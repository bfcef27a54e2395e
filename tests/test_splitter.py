import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.functions.splitter import UnsplittableError, balanced, check_tiling, split
from sparkloom.functions.tokenizer import QuarterTokenizer

T = QuarterTokenizer()


def cut(text, budget, base=0):
    fragments = split(text, base=base, budget=budget, tokenizer=T, path="f.md")
    check_tiling(text, base, fragments, "f.md")
    data = text.encode()
    assert b"".join(data[f.start - base : f.end - base] for f in fragments) == data
    for f in fragments:
        assert T.count(f.text) <= (budget if isinstance(budget, int) else 10**9)
        assert f.text.strip() in data[f.start - base : f.end - base].decode()
        assert balanced(f.body().split("\n"))
    return fragments


def test_counts_by_hand():
    assert [T.count(x) for x in ("abcd", "abcde", "DocumentPropertySet", "ab\n\nabcd", "   ")] == [1, 2, 5, 2, 0]


def test_paragraphs_move_whole():
    assert [(f.start, f.end) for f in cut("Alpha beta gamma.\n\nDelta epsilon zeta.", 6, 1000)] == [(1000, 1019), (1019, 1038)]


def test_sentences_lines_and_words():
    assert [(f.start, f.end) for f in cut("One two. Three four. Five six.", 4)] == [(0, 9), (9, 21), (21, 30)]
    assert len(cut("aaaa bbbb cccc\ndddd eeee ffff\ngggg hhhh iiii", 4)) == 3
    assert len(cut("aaaa bbbb cccc dddd", 2)) == 2


def test_exact_budget_is_one_fragment():
    assert len(cut("aaaa bbbb cccc", 3)) == 1 and len(cut("aaaa bbbb cccc", 2)) == 2


def test_fence_stays_whole_if_it_fits():
    found = cut("Some words that come before it all.\n\n```groovy\nx = 1\n```", 12)
    assert len(found) == 2 and found[1].text.startswith("```groovy") and found[1].fence_open is None


def test_cut_fence_is_closed_and_opened_again():
    found = cut("```groovy\nalpha beta\ngamma delta\nepsilon zeta\n```", 5)
    assert found[0].fence_close == "```" and found[1].fence_open == "```groovy"
    assert found[-1].fence_close is None and found[-1].text.endswith("```")


def test_long_code_line_is_cut_between_words():
    found = cut("```\n" + "aaaa " * 9 + "aaaa\n```", 4)
    assert all(f.fence_open == "```" or i == 0 for i, f in enumerate(found))


def test_multibyte_cuts_fall_between_code_points():
    assert [(f.start, f.end) for f in cut("\U0001f600" * 24, 3, 200)] == [(200, 248), (248, 296)]


def test_room_left_is_filled_when_a_unit_must_be_cut_anyway():
    found = cut("alpha. " + " ".join(["twopiece"] * 40), 10)
    assert T.count(found[0].text) == 10


def test_failure_says_where():
    with pytest.raises(UnsplittableError) as e:
        split("abc def", base=50, budget=0, tokenizer=T, path="p.md")
    assert (e.value.line, e.value.start, e.value.end, e.value.path) == (1, 50, 53, "p.md")


def test_blank_text_is_covered_and_empty_text_is_nothing():
    assert [(f.start, f.end) for f in cut("  \n ", 5)] == [(0, 4)] and cut("", 5) == []


def test_tiling_checks():
    a, b = cut("One two. Three four.", 4)
    for bad in ([b], [a], [a, a, b], [a._replace(end=a.start), b]):
        with pytest.raises(ValueError):
            check_tiling("One two. Three four.", 0, bad)


PIECES = st.lists(st.sampled_from(["word", "longerword", ". ", "! ", " ", "\n", "\n\n", "```\n", "\n```\n", "~~~xml\n", "\n~~~\n", "é", "\U0001f600", "x = 1;", "\t"]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(6, 30))
def test_any_text_tiles(pieces, budget):
    text = "".join(pieces)
    try:
        cut(text, budget)
    except UnsplittableError:
        pass


def test_counts_of_spans():
    import random

    rng, counter = random.Random(3), QuarterTokenizer()
    for _ in range(300):
        text = "".join(rng.choice("abcdefé \n\x1c　") for _ in range(rng.randrange(25)))
        count = counter.counter_of(text)
        assert all(count(a, b) == counter.count(text[a:b]) for a in range(len(text) + 1) for b in range(len(text) + 1))
