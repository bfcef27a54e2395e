from hypothesis import given
from hypothesis import strategies as st

from sparkloom.functions import html, markdown


def names(found):
    return [(s.tag, s.heading, s.breadcrumb, s.url, html.text_of(s.nodes)) for s in found]


WAY = "<p>" + "<strong>Path:</strong> "
PAGE = f"""<h1>Top</h1>{WAY}<a href="http://a/">A</a> &gt; <a href="http://a/b">B</a></p><div><h2>One</h2><div><p>x <b>y</b></p></div></div>bare
<h3>Two</h3>{WAY}<a href="http://a/c">C</a></p><blockquote><h2>inner</h2></blockquote><h8>Deep</h8>"""


def test_sections_and_carried_paths():
    assert names(html.sections(html.parse(PAGE))) == [
        ("h1", "Top", "A > B", "http://a/b", ""),
        ("h2", "One", "A > B", "http://a/b", "x y\nbare"),
        ("h3", "Two", "C", "http://a/c", "inner"),
        ("h8", "Deep", "C", "http://a/c", ""),
    ]


def test_tree_is_forgiving():
    assert html.parse("<p>a<br>b</i></p>c</p>").render() == "<p>a<br/>b</p>c"
    assert html.parse("<b><i>x</b>y</i>").render() == "<b><i>x</i></b>y"
    assert html.parse("a &amp; b &lt;").render() == "a &amp; b &lt;"
    assert html.parse("<!-- c --><p>t").text() == "t"


def test_assets_speak_only_for_themselves():
    root = html.parse("<div><style>p{}</style>t<script>x<y</script></div>")
    assert root.text() == "t" and root.first("style").text() == "p{}"
    html.drop_assets(root)
    assert root.render() == "<div>t</div>"


def test_links_and_styling():
    root = html.parse('<p class="a" id="b"><a href="/x">1</a><a href="http://o/">2</a><img src="/i.png"><img src="j.png"><svg><path/></svg></p>')
    html.absolute_urls(root, "https://h")
    html.drop_styling(root)
    assert root.render() == '<p><a href="https://h/x">1</a><a href="http://o/">2</a><img src="https://h/i.png"/><img src="j.png"/></p>'
    assert html.absolute_link("/a b/é", "https://h") == "https://h/a%20b/%C3%A9" and html.absolute_link("http://x y", "https://h") == "http://x y"


def test_blocks_pack_to_the_limit():
    page = "<div>" + "".join(f"<p>{c * 16}</p>" for c in "abcd") + "</div>"
    packs = html.split_blocks(page, 8)
    assert [html.plain_text(p) for p in packs] == ["a" * 16 + " " + "b" * 16, "c" * 16 + " " + "d" * 16]
    assert len(html.split_blocks(f"<p>{'x' * 400}</p>", 8)) == 1 and html.split_blocks("  ", 5) == []


def test_sidebar():
    nav = """<nav class="menu"><ul><li class="level-2"><a class="menu__link menu__link--sublist" href="/a">A</a></li><li class="level-3"><a class="menu__link" href="/b" aria-current="page">B</a></li>
    <li class="level-4"><a class="menu__link" href="/c">C</a></li><li class="level-5"><a class="menu__link" href="/d">D</a></li><li><a class="menu__link" href="/e">no level</a></li><li class="level-4"><a class="menu__link" href="/e">E</a></li>
    <li class="level-3"><a class="menu__link" href="/f">F</a></li><li class="level-2"><a class="menu__link" href="#x">x</a></li><li class="level-2"><a class="menu__link" href="http://other/">o</a></li>
    <li class="level-2"><a class="menu__link" href="/a" aria-current="page">again</a></li></ul></nav>"""
    items = html.sidebar(html.parse(nav))
    assert [(i["href"], i["level"], i["is_category"], i["is_current"]) for i in items] == [("/a", 2, True, True), ("/b", 3, False, True), ("/c", 4, False, False), ("/d", 5, False, False), ("/e", 4, False, False), ("/f", 3, False, False)]
    items[0]["is_current"] = False
    assert [i["href"] for i in html.current_children(items)] == ["/c", "/e"]
    assert html.current_children([]) == [] and html.sidebar(html.parse("<p>")) == []


MD = "intro é\n\n# Title ##\n\n body\n\n## Part C#\n```\n# no heading\n~~~\n```\ntail\n#### deep\n### Empty\n"


def test_markdown_sections_and_spans():
    found = markdown.sections(MD)
    assert [(s.level, s.heading) for s in found] == [(0, ""), (1, "Title"), (2, "Part C#"), (3, "Empty")]
    data = MD.encode()
    for s in found:
        assert data[s.start : s.end].decode() == s.body
    assert found[3].start == found[3].end == len(data) and markdown.title_of(found) == "Title"


@given(st.lists(st.sampled_from(["# a", "## b", "", "text é", "```", "~~~~", "### c ###", "  x"]), max_size=20))
def test_markdown_spans_always_decode(lines):
    text = "\n".join(lines)
    for s in markdown.sections(text):
        assert text.encode()[s.start : s.end].decode() == s.body


def section(level, heading, body="b"):
    return markdown.Section(level, heading, body, 0, 0)


def test_curation():
    doc = [section(1, "Doc"), section(2, "Contents"), section(2, "Groovy use"), section(3, "Child"), section(2, "Other"), section(3, "XML Structure")]
    kept = lambda *a: [s.heading for s in markdown.curate(doc, *a)]
    assert kept() == ["Doc", "Groovy use", "Child", "Other", "XML Structure"]
    assert kept(["groovy"]) == ["Groovy use", "Child"] and kept(None, ["other"]) == ["Doc", "Groovy use", "Child"]
    warn = [section(1, "Doc", "a Tech Preview"), section(1, "Again", "Technology Preview"), section(2, "Dropped", "tech preview")]
    assert [s.heading for s in markdown.curate(warn, ["zzz"])] == ["Doc"]
    assert [s.heading for s in markdown.curate(warn, None, ["dropped"])] == ["Doc", "Again", "Dropped"]


def test_markup_blocks():
    big = "<a>" + "x" * 1500 + "</a>"
    assert markdown.strip_markup_blocks(f"  ```xml\n{big}\n  ```\nrest") == f"  {markdown.OMITTED}\nrest"
    assert markdown.OMITTED in markdown.strip_markup_blocks(f"~~~\n<!-- c -->{big}\n~~~")
    for same in (f"```groovy\n{big}\n```", "```xml\n<a/>\n```", f"```\ndef {big}\n```", f"```xml\n{big}\n~~~"):
        assert markdown.strip_markup_blocks(same) == same


def test_component_gate():
    yes = ["<ns:Component>", "<_p:Component a='1'>", '<Component type="x">', "<Component\n xmlns = 'u'/>", '<Component a=">" componentId="1">']
    no = ["<Component>", "<ComponentReference type='x'>", "<ns:Components>", "<Component-Ref type='a'>", '<Component note="type=1">', '<Component data-type="x">', "plain", None]
    assert all(map(markdown.has_raw_component, yes)) and not any(map(markdown.has_raw_component, no))


def test_rendering():
    text = "# H\n\npara *it* `a<b`\n\n- one\n- two\n\n```xml\n<a/>\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |"
    out = markdown.render(text)
    for part in ("<h1>H</h1>", "<em>it</em>", "<code>a&lt;b</code>", "<li>two</li>", 'class="language-xml"', "&lt;a/&gt;", "<td>2</td>"):
        assert part in out
