"""A forgiving HTML tree on the standard parser, and the section view of a page.

Tree rules: void elements hold nothing; an end tag closes back to its nearest open element and is ignored without
one; nothing is closed implicitly; text of scripts and styles, comments and declarations are nodes of their own kind.
"""

from __future__ import annotations

import html as entities
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import quote, urljoin, urlparse

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(f"h{level}" for level in range(1, 9))


@dataclass(eq=False)
class Text:
    value: str
    kind: str = "text"
    parent: "Element | None" = None

    def render(self) -> str:
        return {"comment": f"<!--{self.value}-->", "doctype": f"<!{self.value}>"}.get(self.kind, self.value)


@dataclass(eq=False)
class Element:
    name: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list["Element | Text"] = field(default_factory=list)
    parent: "Element | None" = None

    def add(self, child: "Element | Text") -> None:
        child.parent = self
        self.children.append(child)

    def walk(self) -> Iterator["Element | Text"]:
        """Everything below, in document order."""
        pending = self.children[::-1]
        while pending:
            node = pending.pop()
            yield node
            if isinstance(node, Element):
                pending.extend(reversed(node.children))

    def elements(self, *names: str) -> list["Element"]:
        return [n for n in self.walk() if isinstance(n, Element) and (not names or n.name in names)]

    def first(self, name: str) -> "Element | None":
        return next((n for n in self.walk() if isinstance(n, Element) and n.name == name), None)

    def strings(self) -> Iterator[str]:
        """Plain text; of scripts and styles only when they themselves are asked."""
        own = self.name if self.name in ("script", "style", "template") else "text"
        return (n.value for n in self.walk() if isinstance(n, Text) and n.kind in (own, "cdata"))

    def text(self, between: str = "", stripped: bool = False) -> str:
        return between.join(x for s in self.strings() if (x := s.strip() if stripped else s))

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def remove(self) -> None:
        if self.parent:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def dissolve(self) -> None:
        """Put the children in this element's place."""
        if self.parent:
            at = next(i for i, c in enumerate(self.parent.children) if c is self)
            for c in self.children:
                c.parent = self.parent
            self.parent.children[at : at + 1] = self.children

    def render(self) -> str:
        out: list[str] = []
        pending: list[Element | Text | str] = [self]
        while pending:
            node = pending.pop()
            if isinstance(node, str):
                out.append(node)
            elif isinstance(node, Text):
                out.append(entities.escape(node.value, quote=False) if node.kind == "text" else node.render())
            elif node.name == "#root":
                pending.extend(reversed(node.children))
            else:
                attrs = "".join(f" {k}={_quoted(v)}" for k, v in node.attrs.items())
                if node.name in VOID:
                    out.append(f"<{node.name}{attrs}/>")
                else:
                    out.append(f"<{node.name}{attrs}>")
                    pending.append(f"</{node.name}>")
                    pending.extend(reversed(node.children))
        return "".join(out)


def _quoted(value: str) -> str:
    safe = entities.escape(value, quote=False)
    return f"'{safe}'" if '"' in safe and "'" not in safe else '"' + safe.replace('"', "&quot;") + '"'


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("#root")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].add(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].add(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def _say(self, value: str, kind: str) -> None:
        top = self.open[-1]
        if kind == "text" and top.name in ("script", "style", "template"):
            kind = top.name
        if top.children and isinstance(last := top.children[-1], Text) and last.kind == kind != "comment":
            last.value += value
        else:
            top.add(Text(value, kind))

    def handle_data(self, data: str) -> None:
        self._say(data, "text")

    def handle_comment(self, data: str) -> None:
        self._say(data, "comment")

    def handle_decl(self, decl: str) -> None:
        self._say(decl, "doctype")

    def unknown_decl(self, data: str) -> None:
        self._say(data.removeprefix("CDATA["), "cdata" if data.startswith("CDATA[") else "doctype")

    def handle_pi(self, data: str) -> None:
        self._say(data, "comment")


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def container(root: Element, name: str, classes: str | None = None) -> Element | None:
    """First element of that name whose class attribute is exactly ``classes`` (any, if None)."""
    return next((e for e in root.elements(name) if classes is None or " ".join(e.classes()) == classes), None)


def absolute_urls(root: Element, base: str) -> None:
    """Links without scheme and host, and images from the root, get the page's host."""
    for a in root.elements("a"):
        if "href" in a.attrs:
            parts = urlparse(a.attrs["href"])
            if not (parts.scheme or parts.netloc):
                a.attrs["href"] = urljoin(base, a.attrs["href"])
    for image in root.elements("img"):
        if image.attrs.get("src", "").startswith("/"):
            image.attrs["src"] = urljoin(base, image.attrs["src"])


def drop_styling(root: Element) -> None:
    """No classes, no ids, no vector drawings."""
    for e in root.elements():
        e.attrs.pop("class", None)
        e.attrs.pop("id", None)
    for drawing in root.elements("svg"):
        drawing.remove()


def drop_assets(root: Element) -> None:
    """Scripts and styles must go before elements are read one by one: asked itself, each would return its source."""
    for asset in root.elements("style", "script"):
        asset.remove()


def absolute_link(href: str, base: str) -> str:
    """A sidebar link as a full URL, percent-encoded."""
    return href if href.startswith("http") else base + quote(href, safe="/:@%")


def _path_of(node: Element) -> tuple[str, str] | None:
    """(breadcrumb, source URL) if this is a page's path paragraph."""
    if node.name != "p" or not (bold := node.first("strong")) or not bold.text(stripped=True).startswith("Path:"):
        return None
    links = node.elements("a")
    names = [n for link in links if (n := link.text(stripped=True))]
    targets = [t for link in links if (t := link.attrs.get("href"))]
    return " > ".join(names), targets[-1] if targets else ""


def text_of(nodes: list[Element | Text]) -> str:
    """Lines of text, one a node."""
    lines = (n.value.strip() if isinstance(n, Text) else n.text(" ", True) for n in nodes)
    return "\n".join(x for x in lines if x).strip()


def html_of(nodes: list[Element | Text]) -> str:
    return "\n".join(n.render() for n in nodes).strip()


@dataclass
class Section:
    tag: str | None
    heading: str
    breadcrumb: str = ""
    url: str = ""
    nodes: list[Element | Text] = field(default_factory=list)


def sections(root: Element) -> list[Section]:
    """Sections at top-level headings. Path paragraphs are metadata: a section without one has the last seen."""
    for div in root.elements("div"):
        div.dissolve()
    found = [Section(None, "")]
    last = ("", "")
    inherited: dict[int, tuple[str, str]] = {}
    for node in root.children:
        here = found[-1]
        if isinstance(node, Text):
            if node.value.strip():
                here.nodes.append(node)
        elif node.name in HEADINGS:
            inherited[id(here)] = last
            found.append(Section(node.name, node.text(stripped=True)))
        elif (path := _path_of(node)) is not None:
            here.breadcrumb, here.url = last = path
        else:
            here.nodes.append(node)
    inherited[id(found[-1])] = last
    kept = [s for s in found if s.nodes or s.heading]
    for s in kept:
        if not s.breadcrumb:
            s.breadcrumb, s.url = inherited[id(s)]
    return kept


def page_title(found: list[Section], default: str) -> str:
    return next((s.heading for s in found if s.tag == "h1"), default)


def split_blocks(html: str, most: int) -> list[str]:
    """Pack top-level nodes while their text's quarter length stays within ``most``; a node too large stays whole."""
    root = parse(html)
    for div in root.elements("div"):
        div.dissolve()
    nodes = [n for n in root.children if isinstance(n, Element) or n.value.strip()]
    if not nodes:
        return [html] if html.strip() else []
    packs: list[list[str]] = []
    text = ""
    for n in nodes:
        own = n.value.strip() if isinstance(n, Text) else n.text(" ", True)
        joined = f"{text}\n{own}".strip() if text else own
        if packs and len(joined) // 4 <= most:
            packs[-1].append(n.render())
            text = joined
        else:
            packs.append([n.render()])
            text = own
    return ["\n".join(p).strip() for p in packs]


def plain_text(html: str) -> str:
    return parse(html).text(" ", True)


def sidebar(root: Element, hosts: frozenset[str] = frozenset(), menu: str = "menu", link: str = "menu__link", sublist: str = "menu__link--sublist") -> list[dict]:
    """Links of the page's menu with their levels, the first of each target.

    A target met again can only turn current; rows without a level don't count as met.
    """
    nav = next((n for n in root.elements("nav") if menu in n.classes()), None)
    rows: dict[str, dict] = {}
    for a in nav.elements("a") if nav else ():
        href = a.attrs.get("href", "")
        if link not in a.classes() or not href or href[0] == "#" or (href.startswith("http") and urlparse(href).netloc not in hosts):
            continue
        current = a.attrs.get("aria-current") == "page"
        if href in rows:
            rows[href]["is_current"] |= current
            continue
        item = a.parent
        while item and item.name != "li":
            item = item.parent
        marks = [c.rpartition("level-")[2] for c in (item.classes() if item else ()) if "level-" in c]
        levels = [int(m) for m in marks if m.lstrip("-").isdigit()]
        if levels:
            rows[href] = {"pos": len(rows), "level": levels[-1], "href": href, "text": a.text(stripped=True), "is_category": sublist in a.classes(), "is_current": current}
    return list(rows.values())


def current_children(items: list[dict]) -> list[dict]:
    """The items one level below the current page's, up to the next that isn't below it."""
    at = next((i for i, x in enumerate(items) if x["is_current"]), None)
    if at is None:
        return []
    level = items[at]["level"]
    below = items[at + 1 :]
    end = next((i for i, x in enumerate(below) if x["level"] <= level), len(below))
    return [x for x in below[:end] if x["level"] == level + 1]
