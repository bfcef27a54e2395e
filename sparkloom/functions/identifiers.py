"""What a document's code says: share of code, structural identifiers and facts; and checks of a description of it."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

from sparkloom.functions.header import COMPANION
from sparkloom.functions.markdown import closes, fence
from sparkloom.functions.tokenizer import Counter

LEAST_CODE = 0.3
LEAST_IDENTIFIERS = 2
MOST_DESCRIPTION_TOKENS = 128

_LETTER, _ALNUM = "[a-zA-Z]", "[0-9a-zA-Z]"
#: Dotted, underscored, and the two camel-case forms.
WORD_FORMS = (rf"\b(?:[A-Za-z_]\w*\.)+[A-Za-z_]\w*\b", rf"\b{_LETTER}+(?:_{_ALNUM}+)+\b", rf"\b[a-z]+[A-Z]{_ALNUM}*\b", rf"\b[A-Z][0-9a-z]+[A-Z]{_ALNUM}*\b")
_WORDS = [re.compile(p) for p in WORD_FORMS]
_NAME = r"[A-Za-z_][-\w.]*"
_TAG = re.compile(rf"""<(?P<end>/?)(?P<name>{_NAME}(?::{_NAME})?)(?P<attrs>(?:"[^"]*"|'[^']*'|[^"'>])*?)(?P<alone>/?)>""")
_TYPE = re.compile(r"""(?:^|(?<=\s))(?:xsi:)?type\s*=\s*(?P<q>["'])(?P<value>.*?)(?P=q)""", re.S)
_PREFIXED = re.compile(rf"(?:^|\s)({_NAME}):({_NAME})\s*=")


#: After a full stop, question or exclamation mark.
END = re.compile("(?<=[?!.])" + r"\s+")
_VALUE = "|".join(rf"{q}[^{q}]*{q}" for q in "\"'")


class Tag(NamedTuple):
    kind: str  # open, close, alone
    name: str
    attrs: str

    def types(self) -> list[str]:
        return [m["value"] for m in _TYPE.finditer(self.attrs) if m["value"]]

    def prefixes(self) -> list[str]:
        """Of its attributes; a declaration counts for the prefix it declares."""
        bare = re.sub(_VALUE, "''", self.attrs)
        return [(local if prefix == "xmlns" else prefix) + ":" for prefix, local in _PREFIXED.findall(bare)]

    def own_prefix(self) -> list[str]:
        return [self.name.partition(":")[0] + ":"] if ":" in self.name else []


def tags(text: str) -> Iterator[Tag]:
    for m in _TAG.finditer(text):
        yield Tag("close" if m["end"] else "alone" if m["alone"] else "open", m["name"], m["attrs"])


def code_segments(text: str) -> list[str]:
    """Fenced blocks with their fence lines, an unclosed one to the end, and inline spans of other lines."""
    out: list[str] = []
    block: list[str] | None = None
    opened = None
    for line in text.split("\n"):
        if block is None and (opened := fence(line)):
            block = [line]
        elif block is None:
            out += re.findall("`[^`\n]+`", line)
        else:
            block.append(line)
            if closes(line, opened):
                out.append("\n".join(block))
                block = None
    return out + (["\n".join(block)] if block else [])


def code_ratio(text: str, tokenizer: Counter) -> float:
    total = tokenizer.count(text)
    return min(1.0, sum(map(tokenizer.count, code_segments(text))) / total) if total else 0.0


def identifiers(text: str) -> list[str]:
    """Sorted distinct: dotted, underscored and camel-case words; element names, prefixes and type values of markup."""
    found = {w for pattern in _WORDS for w in pattern.findall(text)}
    for tag in tags(text):
        found.update([tag.name], tag.own_prefix(), tag.prefixes(), tag.types())
    return sorted(found)


class Facts(NamedTuple):
    roots: list[str]
    types: list[str]
    prefixes: list[str]


def facts(text: str) -> Facts:
    """Outermost element names, type values and prefixes, each in order of first appearance."""
    roots, types, prefixes = {}, {}, {}
    depth = 0
    for tag in tags(text):
        if tag.kind == "close":
            depth -= depth > 0
            continue
        if not depth:
            roots[tag.name] = None
        prefixes.update(dict.fromkeys(tag.own_prefix() + tag.prefixes()))
        types.update(dict.fromkeys(tag.types()))
        depth += tag.kind == "open"
    return Facts(list(roots), list(types), list(prefixes))


def is_eligible(source_type: str, content: str, tokenizer: Counter) -> bool:
    """May a description stand for this chunk? Companion chunks with enough code and identifiers."""
    return source_type == COMPANION and code_ratio(content, tokenizer) >= LEAST_CODE and len(identifiers(content)) >= LEAST_IDENTIFIERS


def sentences(text: str) -> list[str]:
    return [s for s in END.split(text) if s.strip()]


def description_errors(description: str, *, document: str, known: Sequence[str], topic: str, about: Facts, tokenizer: Counter) -> list[str]:
    """What is wrong with a description: its shape, what it fails to mention, what it invents."""
    said = sentences(description)
    low = description.casefold()

    def mentions(names: Sequence[str]) -> bool:
        return any(n.casefold() in low for n in names)

    errors = []
    if not 1 <= len(said) <= 3:
        errors.append(f"shape: {len(said)} sentences instead of 1 to 3")
    if (n := tokenizer.count(description)) > MOST_DESCRIPTION_TOKENS:
        errors.append(f"shape: {n} tokens, {MOST_DESCRIPTION_TOKENS} are allowed")
    if re.search("`{3}|~{3}", description):
        errors.append("shape: code fence")
    if re.search(r"<[!/?A-Za-z_]", description):
        errors.append("shape: markup")
    if topic.casefold() not in (said[0].casefold() if said else ""):
        errors.append(f"mandatory: topic {topic!r} isn't in the first sentence")
    if about.roots and not mentions(about.roots):
        errors.append(f"mandatory: no root element of {about.roots}")
    if about.types and not mentions(about.types):
        errors.append(f"mandatory: no type value of {about.types}")
    material = [p for p in about.prefixes if document.count(p) >= 2]
    if material and not mentions([p.rstrip(":") for p in material]):
        errors.append(f"mandatory: no prefix of {material}")
    errors += [f"introduced_identifier: {x!r} isn't in the source" for x in identifiers(description) if x not in known and x not in document]
    return errors
