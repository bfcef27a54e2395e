"""Context headers: breadcrumb and title lines that say nothing twice, within a token cap."""

from __future__ import annotations

from typing import NamedTuple

from sparkloom.functions.tokenizer import Counter

CAP = 64
OFFICIAL = "official"
COMPANION = "companion_reference"


class TitleTooLongError(ValueError):
    """The title alone is over the cap, and titles aren't cut."""

    def __init__(self, title: str, tokens: int, cap: int) -> None:
        super().__init__(f"title {title!r} has {tokens} tokens, the header may have {cap}")
        self.title, self.tokens, self.cap = title, tokens, cap


class Header(NamedTuple):
    lines: tuple[str, ...]
    text: str
    tokens: int


def fold(text: str) -> str:
    """For comparison: case folded, white space runs as one space."""
    return " ".join(text.split()).casefold()


def build(source_type: str, title: str, breadcrumb: str | None, first_line: str, tokenizer: Counter, cap: int = CAP) -> Header:
    """Header of a chunk whose text begins with ``first_line``.

    Left out: a breadcrumb's last segment that repeats the title, a line that the first line of the text begins with
    (an empty one always does), a line equal to the one before. Over the cap, segments go from the left.
    """
    if source_type not in (OFFICIAL, COMPANION):
        raise ValueError(f"no such source type: {source_type!r}")
    crumbs = (breadcrumb or "").split(" > ") if source_type == COMPANION else []
    if crumbs and fold(crumbs[-1]) == fold(title):
        crumbs.pop()
    said = fold(first_line)
    if said.startswith(fold(" > ".join(crumbs))):
        crumbs = []
    show_title = not said.startswith(fold(title)) and not (crumbs and fold(" > ".join(crumbs)) == fold(title))
    while True:
        lines = ((" > ".join(crumbs),) if crumbs else ()) + ((title,) if show_title else ())
        text = "\n".join(lines)
        tokens = tokenizer.count(text)
        if tokens <= cap:
            return Header(lines, text, tokens)
        if not crumbs:
            raise TitleTooLongError(title, tokens, cap)
        crumbs = crumbs[1:]
