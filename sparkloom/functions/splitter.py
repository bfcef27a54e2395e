"""Splitting a section's text under a token budget, with byte spans that tile it.

Filling is greedy over contiguous text. Prose goes by paragraph, sentence, line, word and code point: what doesn't fit
the room left but would fit a fragment of its own moves there whole; what wouldn't is taken apart, its first pieces
filling the room left. A fenced block goes whole, else by lines, whose fence lines are never cut; a fragment that ends
or begins inside it gets a closing or opening line of its own, which has no span. White space between fragments belongs
to the span before it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from typing import NamedTuple

from sparkloom.functions.markdown import closes, fence
from sparkloom.functions.tokenizer import Counter

#: From coarse to fine.
BREAKS = [re.compile(p) for p in (r"\n{2,}", "(?<=[?!.])" + r"\s+", r"\n", r"\s+")]
WORDS = len(BREAKS) - 1


class UnsplittableError(ValueError):
    """No piece of the source fits; says where."""

    def __init__(self, path: str, line: int, start: int, end: int, why: str) -> None:
        super().__init__(f"{path}: line {line}, bytes [{start}, {end}): {why}")
        self.path, self.line, self.start, self.end, self.why = path, line, start, end, why


class Fragment(NamedTuple):
    text: str
    start: int
    end: int
    fence_open: str | None = None
    fence_close: str | None = None

    def body(self) -> str:
        """The text with its own fence lines."""
        return "\n".join(x for x in (self.fence_open, self.text, self.fence_close) if x is not None)


class _Line(NamedTuple):
    start: int
    end: int
    role: str  # text, open, body, close


class _Part(NamedTuple):
    """A fragment's content by character offsets."""

    start: int
    end: int
    fence_open: str | None
    fence_close: str | None


def _blocks(text: str) -> list[tuple[list[_Line], str, str]]:
    """Runs of lines: (lines, fence mark, language), the mark empty for prose."""
    out: list[tuple[list[_Line], str, str]] = []
    opened: tuple[str, int] | None = None
    at = 0
    for line in text.split("\n"):
        span = at, at + len(line)
        at += len(line) + 1
        if opened:
            shut = closes(line, opened)
            out[-1][0].append(_Line(*span, "close" if shut else "body"))
            opened = None if shut else opened
        elif mark := fence(line):
            opened = mark
            out.append(([_Line(*span, "open")], mark[0] * mark[1], line.strip()[mark[1] :].strip()))
        elif out and not out[-1][1]:
            out[-1][0].append(_Line(*span, "text"))
        else:
            out.append(([_Line(*span, "text")], "", ""))
    return out


def balanced(lines: list[str]) -> bool:
    """Every fence that opens is closed."""
    opened = None
    for line in lines:
        if opened is None:
            opened = fence(line)
        elif closes(line, opened):
            opened = None
    return opened is None


class _Filler:
    def __init__(self, text: str, base: int, budget: Callable[[int], int], tokenizer: Counter, path: str) -> None:
        self.text, self.base, self.budget, self.tokenizer, self.path = text, base, budget, tokenizer, path
        self.known = 0, 0  # a place and the bytes before it
        counter_of = getattr(tokenizer, "counter_of", None)
        self.size = counter_of(text) if counter_of else lambda start, end: tokenizer.count(text[start:end])
        self.parts: list[_Part] = []
        self.start: int | None = None  # of the fragment being filled
        self.end = 0
        self.own_open: str | None = None
        self.owed: str | None = None  # opening line for the next fragment
        self.inside: tuple[str, str] | None = None  # mark and language of the fence that the text is in

    def byte(self, at: int) -> int:
        place, size = self.known if self.known[0] <= at else (0, 0)
        self.known = at, size + len(self.text[place:at].encode())
        return self.base + self.known[1]

    def fail(self, start: int, end: int, why: str, at: int | None = None) -> UnsplittableError:
        return UnsplittableError(self.path, self.text.count("\n", 0, start if at is None else at) + 1, self.byte(start), self.byte(end), why)

    def begin(self, start: int, end: int) -> None:
        self.start, self.end = start, end
        self.own_open, self.owed = self.owed, None

    def seal(self) -> None:
        """End the fragment being filled, if there is one."""
        if self.start is None:
            return
        shut = None
        if self.inside:
            shut = self.inside[0]
            self.owed = "".join(self.inside)
        self.parts.append(_Part(self.start, self.end, self.own_open, shut))
        self.start = self.own_open = None

    def fits_alone(self, start: int, end: int) -> bool:
        return self.size(start, end) <= self.budget(len(self.parts) + (self.start is not None))

    def take(self, start: int, end: int) -> bool:
        """Put the text up to ``end`` into the fragment being filled, or a new one, if there is room."""
        anchor = start if self.start is None else self.start
        if self.size(anchor, end) > self.budget(len(self.parts)):
            return False
        if self.start is None:
            self.begin(start, end)
        self.end = end
        return True

    def take_or_move(self, start: int, end: int) -> bool:
        """Put the text into this fragment, or whole into the next where it fits that alone."""
        if self.take(start, end):
            return True
        if not self.fits_alone(start, end):
            return False
        self.seal()
        return self.take(start, end)

    def prose(self, start: int, end: int, level: int) -> None:
        if level > WORDS:
            self.points(start, end)
            return
        edges = [start]
        for m in BREAKS[level].finditer(self.text[start:end]):
            edges += [start + m.start(), start + m.end()]
        edges.append(end)
        for a, b in zip(edges[::2], edges[1::2]):
            if self.text[a:b].strip() and not self.take_or_move(a, b):
                self.prose(a, b, level + 1)

    def points(self, start: int, end: int) -> None:
        """The longest run of code points that fits, again and again."""
        while start < end:
            if self.start is not None:
                most = self.longest(self.start, start, end)
                if most == start:
                    self.seal()
                    continue
                self.end = most
            else:
                most = self.longest(start, start, end)
                if most == start:
                    raise self.fail(start, end, "not one code point fits the budget")
                self.begin(start, most)
            start = most

    def longest(self, anchor: int, low: int, high: int) -> int:
        budget = self.budget(len(self.parts))
        found = low + bisect_right(range(low + 1, high + 1), budget, key=lambda k: self.size(anchor, k))
        while found > low and self.size(anchor, found) > budget:
            found -= 1
        return found

    def code(self, lines: list[_Line], mark: str, language: str) -> None:
        shut = lines[-1].role == "close"
        if self.take_or_move(lines[0].start, lines[-1].end):
            self.inside = None if shut else (mark, language)
            return
        for line in lines:
            if not self.take_or_move(line.start, line.end):
                if line.role != "body":
                    raise self.fail(line.start, line.end, "a fence line can't be cut")
                self.seal()  # else what is left of the room could cut the line at a run of fence characters
                self.prose(line.start, line.end, WORDS)
            if line.role == "open":
                self.inside = (mark, language)
            elif line.role == "close":
                self.inside = None

    def run(self) -> list[Fragment]:
        for lines, mark, language in _blocks(self.text):
            if mark:
                self.code(lines, mark, language)
            else:
                following = lines[-1].end
                self.prose(lines[0].start, min(len(self.text), following + 1), 0)
        self.seal()
        if not self.parts:
            self.parts = [_Part(0, len(self.text), None, None)]
        starts = [0, *(p.start for p in self.parts[1:]), len(self.text)]
        return [self.fragment(p, a, b) for p, a, b in zip(self.parts, starts, starts[1:])]

    def fragment(self, part: _Part, start: int, end: int) -> Fragment:
        text = self.text[part.start : part.end]
        lines = text.split("\n")
        opening, closing = part.fence_open, part.fence_close
        own = opening or closing
        if own is not None:
            char = own[0]
            runs = [len(x) - len(x.lstrip(char)) if x else 0 for x in (opening, closing)]
            language = opening.lstrip(char) if opening else ""
            for length in range(max(3, *runs), max(3, *runs) + max(map(len, lines)) + 2):
                opening = char * length + language if opening is not None else None
                closing = char * length if closing is not None else None
                if balanced([x for x in (opening, *lines, closing) if x is not None]):
                    break
        if not balanced([x for x in (opening, *lines, closing) if x is not None]):
            raise self.fail(start, end, "no fence lines make this piece of code valid", part.start)
        return Fragment(text, self.byte(start), self.byte(end), opening, closing)


def split(text: str, *, base: int = 0, budget: Callable[[int], int] | int, tokenizer: Counter, path: str = "") -> list[Fragment]:
    """Fragments of ``text``, whose first byte is ``base``; ``budget`` is a number or a function of the fragment's."""
    if not text:
        return []
    return _Filler(text, base, budget if callable(budget) else lambda _: budget, tokenizer, path).run()


def check_tiling(text: str, base: int, fragments: list[Fragment], path: str = "") -> None:
    """Spans follow one another from the first byte to the last, none empty; ValueError where they don't."""
    at, end = base, base + len(text.encode())
    for i, f in enumerate(fragments):
        if f.end <= f.start:
            raise ValueError(f"{path}: fragment {i} has the empty span [{f.start}, {f.end})")
        if f.start != at:
            raise ValueError(f"{path}: {'gap' if f.start > at else 'overlap'} at byte {at}, fragment {i} starts at {f.start}")
        at = f.end
    if at != end:
        raise ValueError(f"{path}: {'gap' if at < end else 'overlap'}: spans end at byte {at}, the text at {end}")
