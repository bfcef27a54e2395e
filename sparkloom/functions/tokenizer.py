"""Token counters: anything with ``count(text) -> int`` serves."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate
from typing import Protocol

WINDOW = 256
SPECIALS = 2
BUDGET = WINDOW - SPECIALS


class Counter(Protocol):
    def count(self, text: str) -> int: ...


class QuarterTokenizer:
    """Deterministic counter whose results can be worked out by hand: each word is a quarter of its length, rounded up."""

    def count(self, text: str) -> int:
        return sum([(len(word) + 3) // 4 for word in text.split()])

    def counter_of(self, text: str) -> Callable[[int, int], int]:
        """``count(text[start:end])`` without counting the words between again: words stand alone here, so sums of them do."""
        places = [m.span() for m in re.finditer(r"\S+", text)]
        starts, ends = [a for a, _ in places], [b for _, b in places]
        before = [0, *accumulate([(b - a + 3) // 4 for a, b in places])]

        def count(start: int, end: int) -> int:
            first, last = bisect_right(ends, start), bisect_left(starts, end)  # the words that reach into the span
            if start >= end or first >= last:
                return 0
            head, tail = starts[first], ends[last - 1]
            if head >= start and tail <= end:
                return before[last] - before[first]
            if last - first == 1:
                return (min(tail, end) - max(head, start) + 3) // 4
            inner = before[last - 1] - before[first + 1]
            return inner + (ends[first] - max(head, start) + 3) // 4 + (min(tail, end) - starts[last - 1] + 3) // 4

        return count


class LibraryTokenizer:
    """A tokenizer file of the tokenizers library; nothing is cut and no specials are added."""

    def __init__(self, path: str) -> None:
        self.path = path

    def count(self, text: str) -> int:
        return len(_library(self.path).encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=4)
def _library(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found
