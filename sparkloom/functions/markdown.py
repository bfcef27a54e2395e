"""Markdown: fences, sections with byte spans, curation, removal of large markup blocks, and a small renderer."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from typing import NamedTuple

LARGE_BLOCK = 1500
OMITTED = "> _(large markup block omitted; see the source)_"
_HEADING = re.compile(r"(?P<marks>#{1,3})\s+(?P<text>.*\S)\s*\Z")
_RUN = re.compile(r"`{3,}|~{3,}")
_MARKUP_BLOCK = re.compile(r"(?ms)^(?P<pad>[ \t]*)(?P<fence>~{3,}|`{3,})[ \t]*(?P<lang>[\w+-]*)[ \t]*\n(?P<body>.*?)\n[ \t]*(?P=fence)[ \t]*$", re.A)
_MARKUP_START = re.compile(r"\s*<(?:\?xml|!--|!\[CDATA\[|!DOCTYPE|[a-z])", re.I)
_NAMESPACED = re.compile(r"<[A-Za-z_][-\w.]*:Component(?=[/>\s])")
_VALUE = re.compile("|".join(rf"{q}[^{q}]*{q}" for q in "\"'"))
_PLAIN_ROOT = re.compile(r"<Component(?=[/>\s])((?:%s|[^\"'>])*)" % _VALUE.pattern)
_ROOT_NAMES = re.compile(r"(?:\A|\s)(?:type|xmlns|componentId)\s*=")


def fence(line: str) -> tuple[str, int] | None:
    """(character, length) of a code fence line."""
    m = _RUN.match(line.strip())
    return (m[0][0], len(m[0])) if m else None


def closes(line: str, opened: tuple[str, int]) -> bool:
    """Same character, no shorter, nothing after it."""
    mark = fence(line)
    return mark is not None and mark[0] == opened[0] and mark[1] >= opened[1] and not line.strip()[mark[1] :].strip()


class Section(NamedTuple):
    level: int
    heading: str
    body: str
    start: int
    end: int


def sections(text: str) -> list[Section]:
    """Sections at headings of up to three marks outside fences; what precedes the first has level 0.

    start and end are UTF-8 byte offsets of the stripped body; an empty body's span is empty, where the body would be.
    """
    found: list[Section] = []
    at = 0  # bytes before the line
    level, heading, body, begin = 0, "", [], 0

    def done(next_line: int) -> None:
        raw = "\n".join(body)
        own = raw.strip()
        if not (heading or own):
            return
        start = begin if body or not heading else min(begin, next_line)
        if own:
            start += len(raw[: len(raw) - len(raw.lstrip())].encode())
        found.append(Section(level, heading, own, start, start + len(own.encode())))

    opened = None
    lines = text.split("\n")
    for i, line in enumerate(lines):
        size = len(line.encode()) + (i + 1 < len(lines))
        if opened:
            if closes(line, opened):
                opened = None
        elif mark := fence(line):
            opened = mark
        elif m := _HEADING.match(line):
            done(at)
            level, heading, body, begin = len(m["marks"]), re.sub(r"\s+#+\s*\Z", "", m["text"]).strip(), [], at + size
            at += size
            continue
        body.append(line)
        at += size
    done(at)
    return found


def title_of(found: Sequence[Section]) -> str:
    return next((s.heading for s in found if s.level == 1 and s.heading), "")


def _named(patterns: Sequence[str], headings: Sequence[str]) -> bool:
    low = [h.lower() for h in headings]
    return any(p.lower() in h for p in patterns for h in low)


def curate(found: Sequence[Section], allow: Sequence[str] | None = None, drop: Sequence[str] | None = None) -> list[Section]:
    """Keep what a curator named: the section's own heading or one above it has an allowed and no dropped pattern.

    Tables of contents go. A section that warns of a technology preview is exempt from both of those; the first such
    preamble or title section is also exempt from the allowed list.
    """
    kept: list[Section] = []
    above: list[tuple[int, str]] = []
    warned = False
    for s in found:
        above = [a for a in above if a[0] < s.level]
        chain = [h for _, h in above] + [s.heading]
        above.append((s.level, s.heading))
        body = s.body.lower()
        warning = "tech preview" in body or "technology preview" in body
        first = warning and s.level <= 1 and not warned
        warned |= first
        refused = not warning and s.heading.lower().strip() == "contents"
        refused |= bool(allow) and not first and not _named(allow or (), chain)
        refused |= bool(drop) and not warning and _named(drop or (), chain)
        if not refused:
            kept.append(s)
    return kept


def strip_markup_blocks(text: str, least: int = LARGE_BLOCK) -> str:
    """Replace fenced XML of ``least`` characters or more by a note. Untagged fences count if they start with markup."""

    def swap(m: re.Match) -> str:
        markup = m["lang"].lower() in ("xml", "xsd") or (not m["lang"] and _MARKUP_START.match(m["body"]))
        return m["pad"] + OMITTED if markup and len(m["body"]) >= least else m[0]

    return _MARKUP_BLOCK.sub(swap, text)


def has_raw_component(text: str | None) -> bool:
    """A serialised component's root element: prefixed, or plain with one of its attributes by name."""
    return bool(text) and (_NAMESPACED.search(text) is not None or _has_plain_root(text))


def _has_plain_root(text: str) -> bool:
    return any(_ROOT_NAMES.search(_VALUE.sub(" ", attrs)) for attrs in _PLAIN_ROOT.findall(text))


_INLINE = [
    (re.compile(r"`([^`]+)`"), r"<code>\1</code>"),
    (re.compile(r"\*\*(.+?)\*\*"), r"<strong>\1</strong>"),
    (re.compile(r"(?<!\*)\*(?!\s)(.+?)(?<!\s)\*(?!\*)"), r"<em>\1</em>"),
    (re.compile(r"!\[([^\]]*)\]\(([^)\s]+)\)"), r'<img alt="\1" src="\2" />'),
    (re.compile(r"\[([^\]]+)\]\(([^)\s]+)\)"), r'<a href="\2">\1</a>'),
]


def _inline(text: str) -> str:
    text = html.escape(text, quote=False)
    for pattern, form in _INLINE:
        text = pattern.sub(form, text)
    return text


def render(text: str) -> str:
    """Headings, paragraphs, flat lists, quotes, fenced code and tables as HTML: enough to read a chunk by."""
    out: list[str] = []
    lines = text.split("\n")
    i = 0
    while i < len(lines):
        line = lines[i]
        if mark := fence(line):
            lang = line.strip()[mark[1] :].strip()
            end = next((k for k in range(i + 1, len(lines)) if closes(lines[k], mark)), len(lines))
            code = html.escape("\n".join(lines[i + 1 : end]), quote=False)
            out.append(f'<pre><code{f" class=\"language-{lang}\"" if lang else ""}>{code}\n</code></pre>')
            i = end + 1
        elif not line.strip():
            i += 1
        elif m := re.match(r"(#{1,6})\s+(.*?)\s*#*\s*\Z", line):
            out.append(f"<h{len(m[1])}>{_inline(m[2])}</h{len(m[1])}>")
            i += 1
        elif "|" in line and i + 1 < len(lines) and re.fullmatch(r"\s*\|?[\s:|-]*-[\s:|-]*", lines[i + 1]):
            rows = []
            while i < len(lines) and "|" in lines[i]:
                rows.append([c.strip() for c in lines[i].strip().strip("|").split("|")])
                i += 1
            head, body = rows[0], rows[2:]
            cells = "".join(f"<th>{_inline(c)}</th>" for c in head)
            out.append(f"<table>\n<thead>\n<tr>{cells}</tr>\n</thead>\n<tbody>" + "".join("\n<tr>" + "".join(f"<td>{_inline(c)}</td>" for c in r) + "</tr>" for r in body) + "\n</tbody>\n</table>")
        elif m := re.match(r"\s*([-*+]|\d+[.)])\s+", line):
            tag = "ol" if m[1][0].isdigit() else "ul"
            items = []
            while i < len(lines) and lines[i].strip():
                bullet = re.match(r"\s*(?:[-*+]|\d+[.)])\s+(.*)", lines[i])
                if bullet:
                    items.append(bullet[1])
                elif items:
                    items[-1] += "\n" + lines[i].strip()
                i += 1
            out.append(f"<{tag}>\n" + "\n".join(f"<li>{_inline(x)}</li>" for x in items) + f"\n</{tag}>")
        else:
            block = []
            while i < len(lines) and lines[i].strip() and not fence(lines[i]) and not re.match(r"#{1,6}\s", lines[i]):
                block.append(lines[i])
                i += 1
            if all(b.lstrip().startswith(">") for b in block):
                out.append("<blockquote>\n<p>" + _inline("\n".join(b.lstrip()[1:].strip() for b in block)) + "</p>\n</blockquote>")
            else:
                out.append(f"<p>{_inline(chr(10).join(block))}</p>")
    return "\n".join(out)
