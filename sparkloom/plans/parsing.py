"""Queries that take the parsers through their rules: documents and pages with headings, fences, markup, menus and code.

Each builds its input from a table's rows with expressions that Spark and DuckDB read alike (``concat``, ``chr``, ``md5``,
``repeat``), so that SQL can say what a parser must find in it, byte by byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from sparkloom.functions import columns as C
from sparkloom.functions import identifiers as I
from sparkloom.functions.tokenizer import QuarterTokenizer
from sparkloom.operators import cache, chunks, tree, validate
from sparkloom.plans.registry import Tables, query

NL = "chr(10)"


def _text(*parts: str) -> str:
    """A concatenation: quoted literals with line ends for ``|``, anything else an expression."""
    out = []
    for part in parts:
        if not part.startswith("'"):
            out.append(part)
            continue
        for k, piece in enumerate(part[1:-1].split("|")):
            out += [NL] * (k > 0) + ([f"'{piece}'"] if piece else [])
    return f"concat({', '.join(out)})"


def _files(source: DataFrame, text: str, *, sections: str = "NULL", drop: str = "NULL", strip: str = "true", area: str = "lang") -> DataFrame:
    names = {"title": "'Some title'", "area": area, "upstream_repo": "'r'", "upstream_commit": "'c'", "raw_url": "'u'", "blob_url": "'b'", "latest_url": "'l'", "text": text}
    return source.select(
        F.expr("concat('d/f', doc_id, '.md')").alias("path"), *[F.expr(v).alias(k) for k, v in names.items()],
        F.expr(sections).cast("array<string>").alias("sections"), F.expr(drop).cast("array<string>").alias("drop_sections"), F.expr(strip).alias("strip_xml_blocks"),
    )


# *** Markdown

HEADED = _text("'Preamble '", "md5(text)", "'|# Title '", "doc_id", "' #||é intro '", "md5(text)", "'|## Part|```|# code '", "md5(text)", "'|```|### Deep ##|#### four|## '", "lang", "'||'")
DIGITS = "length(concat('', doc_id))"


@query(f"""WITH d AS (SELECT *, md5(text) AS m, {DIGITS} AS k, length(lang) AS l FROM documents)
SELECT concat('d/f', doc_id, '.md') AS path, s.* FROM (SELECT doc_id, unnest([
 {{pos: 0, level: 0, heading: '', body: concat('Preamble ', m), start_byte: 0, end_byte: 41}},
 {{pos: 1, level: 1, heading: concat('Title ', doc_id), body: concat('é intro ', m), start_byte: 54 + k, end_byte: 95 + k}},
 {{pos: 2, level: 2, heading: 'Part', body: concat('```', {NL}, '# code ', m, {NL}, '```'), start_byte: 104 + k, end_byte: 151 + k}},
 {{pos: 3, level: 3, heading: 'Deep', body: '#### four', start_byte: 164 + k, end_byte: 173 + k}},
 {{pos: 4, level: 2, heading: lang, body: '', start_byte: 177 + k + l + 1, end_byte: 177 + k + l + 1}}]) AS s FROM d)""")
def markdown_heading_sections(t: Tables) -> DataFrame:
    """Headings of four levels, one inside a fence, one with closing marks, an empty section; bodies by byte."""
    found = chunks.markdown_sections(_files(t.documents, HEADED))
    return found.select("path", "pos", "level", "heading", "body", F.col("body_start_byte").alias("start_byte"), F.col("body_end_byte").alias("end_byte"))


CURATED = _text("'# Guide|Tech preview of '", "doc_id", "'|## Contents|list|## Alpha|one|### Child|two|## Beta (Draft)|three|## Gamma|Technology Preview|## Beta draft notes|tech preview four'")


@query("""SELECT concat('d/f', doc_id, '.md') AS path, pos - 1 AS pos, h[pos] AS heading FROM (SELECT doc_id, h, unnest(generate_series(1, len(h))) AS pos FROM (SELECT doc_id,
CASE doc_id % 3 WHEN 0 THEN ['Guide', 'Alpha', 'Child', 'Beta draft notes'] WHEN 1 THEN ['Guide', 'Alpha', 'Child', 'Beta (Draft)', 'Gamma', 'Beta draft notes']
ELSE ['Guide', 'Alpha', 'Child', 'Gamma', 'Beta draft notes'] END AS h FROM documents))""")
def curated_sections(t: Tables) -> DataFrame:
    """Allowed and dropped patterns, own and inherited; the contents; warnings, the first of which is exempt from the allowed list too."""
    allow = "CASE doc_id % 3 WHEN 0 THEN array('ALPHA', 'beta') END"
    drop = "CASE WHEN doc_id % 3 <> 1 THEN array('draft') END"
    return chunks.markdown_sections(_files(t.documents, CURATED, sections=allow, drop=drop), curated=True).select("path", F.col("pos").cast("long").alias("pos"), "heading")


BLOCK = _text("'# T '", "doc_id", "'||Before '", "md5(text)", "'||```xml|<a>'", "repeat('x', CAST(1490 + doc_id % 7 AS INT))", "'</a>|```'")


@query(f"""SELECT concat('d/f', doc_id, '.md') AS file, concat('companion_f', doc_id, '_', substr(sha1(concat('d/f', doc_id, '.md')), 1, 12), '_000') AS id, concat('T ', doc_id) AS section_heading,
md5(concat('Before ', md5(text), {NL}, {NL}, CASE WHEN doc_id % 2 = 0 AND doc_id % 7 >= 3 THEN '> _(large markup block omitted; see the source)_' ELSE concat('```xml', {NL}, '<a>', repeat('x', (1490 + doc_id % 7)::INT), '</a>', {NL}, '```') END)) AS content_md5, 0 AS chunk_index FROM documents""")
def stripped_markup(t: Tables) -> DataFrame:
    """Fenced XML around the limit of 1,500 characters, taken out where the source asks for it."""
    made = chunks.chunk_markdown(_files(t.documents, BLOCK, strip="doc_id % 2 = 0"))
    return made.select("file", "id", "section_heading", F.md5("content").alias("content_md5"), "chunk_index")


WIDE = "repeat('wide ', 100)"
SMALL = _text("'## A|'", WIDE, "'|## Empty|## B|short '", "doc_id", "'|## C|'", WIDE, "'|## D|last'")
AREA_CRUMB = "concat('Companion Reference > ', lang, ' > Some title')"


@query(f"""WITH d AS (SELECT doc_id, lang, unnest([{{i: 0, h: 'A', c: concat('A', {NL}, trim({WIDE}))}}, {{i: 1, h: 'Empty', c: concat('Empty', {NL}, 'B', {NL}, 'short ', doc_id, {NL}, 'C', {NL}, trim({WIDE}), {NL}, 'D', {NL}, 'last')}}]) AS s FROM documents)
SELECT concat('d/f', doc_id, '.md') AS file, s.i AS chunk_index, s.h AS section_heading, md5(s.c) AS content_md5, {AREA_CRUMB} AS breadcrumb, 'companion_unverified' AS verification_status, (length(s.c) // 4)::INT AS token_estimate FROM d""")
def merged_companion_chunks(t: Tables) -> DataFrame:
    """Small sections join the one before them, the last one too; a section without text is small."""
    made = chunks.chunk_markdown(_files(t.documents, SMALL))
    return made.select("file", "chunk_index", "section_heading", F.md5("content").alias("content_md5"), "breadcrumb", "verification_status", "token_estimate")


PARAGRAPH = "concat(repeat('word ', 99), 'end.')"
PARAGRAPHS = f"concat('## Sect', {NL}, {PARAGRAPH}, repeat(concat({NL}, {NL}, {PARAGRAPH}), CAST(doc_id % 5 AS INT)))"


@query(f"""WITH d AS (SELECT doc_id, 1 + doc_id % 5 AS n FROM documents), c AS (SELECT *, unnest(generate_series(0, (n + 1) // 2 - 1)) AS k FROM d)
SELECT concat('companion://r/d/f', doc_id, '.md') AS record, k::INT AS chunk_index, (8 + 1002 * k)::BIGINT AS start_byte, CASE WHEN 2 * k + 2 >= n THEN 8 + 501 * n - 2 ELSE 8 + 1002 * (k + 1) END::BIGINT AS end_byte,
(12 + 100 * least(2, n - 2 * k))::INT AS tokens, (100 * n)::INT AS source_tokens FROM c""")
def companion_span_chunks(t: Tables) -> DataFrame:
    """Paragraphs of 100 tokens under a header of 11 and a heading of one: two fit the budget of 254, a third moves on whole."""
    made = chunks.span_chunk_markdown(_files(t.documents.withColumn("lang", F.lit("en")), PARAGRAPHS))
    return made.select(F.col("source_record_id").alias("record"), "chunk_index", F.col("source_start_byte").alias("start_byte"), F.col("source_end_byte").alias("end_byte"), F.col("embedding_token_count").alias("tokens"), F.col("source_token_count").alias("source_tokens"))


CODE = f"concat('## Sect', {NL}, '```py', {NL}, repeat(concat(repeat('word ', 99), 'end.', {NL}), CAST(1 + doc_id % 5 AS INT)), '```')"


@query(f"""WITH d AS (SELECT doc_id, 1 + doc_id % 5 AS n FROM documents), c AS (SELECT *, unnest(generate_series(0, CASE WHEN n <= 2 THEN 0 ELSE (n + 1) // 2 - 1 END)) AS k FROM d)
SELECT concat('companion://r/d/f', doc_id, '.md') AS record, k::INT AS chunk_index, k > 0 AS opened, n > 2 AND 2 * k + 2 < n AS closed FROM c""")
def fenced_span_chunks(t: Tables) -> DataFrame:
    """Code of lines of 100 tokens, cut between lines; pieces get fence lines of their own where the source's aren't in them."""
    made = chunks.span_chunk_markdown(_files(t.documents.withColumn("lang", F.lit("en")), CODE))
    wrapper = F.col("synthetic_wrapper_metadata")
    return made.select(F.col("source_record_id").alias("record"), "chunk_index", wrapper["fence_open"].isNotNull().alias("opened"), wrapper["fence_close"].isNotNull().alias("closed"))


# *** HTML


def _made(t: Tables, html: str) -> DataFrame:
    return t.pages.select(F.expr("concat('page_', page_id, '.html')").alias("file"), F.expr(html).alias("html"))


TREE = (
    "concat('<article><h1>Page ', page_id, '</h1><p><strong>Path:</strong> <a href=\"https://h/x\">Docs</a> &gt; <a href=\"https://h/x/', page_id, '\">Leaf</a></p><p>Intro ', md5(url), '</p>',"
    " '<h2>Two</h2><div><p>Body <b>bold</b></p><ul><li>a</li></ul></div><h4>Four</h4><p>tail</p></article><p>outside</p>')"
)


@query("""SELECT concat('page_', page_id, '.html') AS file, s.*, 'Docs > Leaf' AS breadcrumb, concat('https://h/x/', page_id) AS source_url, concat('Page ', page_id) AS page_title FROM (SELECT page_id, unnest([
{pos: 0, heading_tag: 'h1', heading_text: concat('Page ', page_id), content_text: concat('Intro ', md5(url))}, {pos: 1, heading_tag: 'h2', heading_text: 'Two', content_text: concat('Body bold', chr(10), 'a')},
{pos: 2, heading_tag: 'h4', heading_text: 'Four', content_text: 'tail'}]) AS s FROM pages)""")
def html_heading_sections(t: Tables) -> DataFrame:
    """Headings of three levels; the path paragraph is metadata and holds for the sections after it."""
    found = chunks.html_sections(_made(t, TREE), element="article")
    return found.select("file", "pos", "heading_tag", "heading_text", "content_text", "breadcrumb", "source_url", "page_title")


@query("""SELECT concat('page_', page_id, '.html') AS file, concat('page_', page_id, '_000') AS id, 'Leaf' AS title, concat('Page ', page_id) AS section_heading, 'Docs' AS category, concat('https://h/x/', page_id) AS page_key,
concat('Intro ', md5(url), chr(10), 'Two', chr(10), 'Body bold', chr(10), 'a', chr(10), 'Four', chr(10), 'tail') AS content, 0 AS chunk_index FROM pages""")
def html_chunks_merged(t: Tables) -> DataFrame:
    made = chunks.chunk_pages(_made(t, TREE), element="article")
    return made.select("file", "id", "title", "section_heading", "category", "page_key", "content", "chunk_index")


LONG_PARAGRAPH = "repeat('long text ', 200)"
LONG_PAGE = f"concat('<article><h2>H</h2>', repeat(concat('<p>', {LONG_PARAGRAPH}, '</p>'), CAST(1 + page_id % 6 AS INT)), '</article>')"
CLEAN = f"trim({LONG_PARAGRAPH})"


@query(f"""WITH p AS (SELECT page_id, 1 + page_id % 6 AS n FROM pages), c AS (SELECT *, unnest(generate_series(0, CASE WHEN n <= 2 THEN 0 ELSE (n + 1) // 2 - 1 END)) AS k FROM p)
SELECT concat('page_', page_id, '.html') AS file, concat('page_', page_id, '_', lpad(k::VARCHAR, 3, '0')) AS id, k::INT AS chunk_index,
md5(concat('H', {NL}, {CLEAN}, CASE WHEN 2 * k + 2 <= n THEN concat(CASE WHEN n <= 2 THEN {NL} ELSE ' ' END, {CLEAN}) ELSE '' END)) AS content_md5 FROM c""")
def html_chunks_cut(t: Tables) -> DataFrame:
    """Paragraphs of 500 tokens: two a chunk of 1,200, each chunk under the heading."""
    made = chunks.chunk_pages(_made(t, LONG_PAGE), element="article")
    return made.select("file", "id", "chunk_index", F.md5("content").alias("content_md5"))


SENTENCE = "concat(repeat('word ', 99), 'end.')"
SENTENCES = f"concat('<article><h2>Sect</h2><script>no</script><p>', {SENTENCE}, repeat(concat(' ', {SENTENCE}), CAST(page_id % 5 AS INT)), '</p></article>')"


@query("""WITH p AS (SELECT page_id, 1 + page_id % 5 AS n FROM pages), c AS (SELECT *, unnest(generate_series(0, (n + 1) // 2 - 1)) AS k FROM p)
SELECT concat('official:file:page_', page_id) AS record, k::INT AS chunk_index, (5 + 1000 * k)::BIGINT AS start_byte, CASE WHEN 2 * k + 2 >= n THEN 5 + 500 * n - 1 ELSE 5 + 1000 * (k + 1) END::BIGINT AS end_byte FROM c""")
def official_span_chunks(t: Tables) -> DataFrame:
    """A paragraph's sentences of 100 tokens: two a chunk, spans of the page's record."""
    made = chunks.span_chunk_pages(_made(t, SENTENCES), element="article")
    return made.select(F.col("source_record_id").alias("record"), "chunk_index", F.col("source_start_byte").alias("start_byte"), F.col("source_end_byte").alias("end_byte"))


@query("SELECT source_type, corpus_ord, count(*) AS n FROM (SELECT 'official' AS source_type, 0 AS corpus_ord FROM pages UNION ALL SELECT 'companion_reference', 1 FROM documents, (SELECT unnest([1, 2]))) GROUP BY 1, 2")
def united_corpora(t: Tables) -> DataFrame:
    """Official chunks of the pages, then two companion chunks of each document."""
    whole = chunks.union_corpora(chunks.chunk_pages(_made(t, TREE), element="article"), chunks.chunk_markdown(_files(t.documents, SMALL)))
    return whole.groupBy("source_type", "corpus_ord").agg(F.count(F.lit(1)).alias("n"))


# *** menus and trees

MENU = (
    "concat('<nav class=\"other\"><a class=\"menu__link\" href=\"/z\">z</a></nav><nav class=\"menu x\"><ul><li class=\"item level-1\"><a class=\"menu__link menu__link--sublist\" href=\"/a\">A</a></li>',"
    " '<li class=\"level-2\"><a class=\"menu__link\" aria-current=\"page\" href=\"/b\"> B ', page_id, '</a></li><li class=\"level-2\"><a class=\"menu__link\" href=\"/a\">again</a></li>',"
    " '<li class=\"level-3\"><a class=\"menu__link\" href=\"#frag\">no</a></li><li><a class=\"menu__link\" href=\"/nolevel\">no</a></li><li class=\"level-3\"><a class=\"menu__link\" href=\"https://other.host/x\">no</a></li>',"
    " '<li class=\"level-3\"><a class=\"plain\" href=\"/plain\">no</a></li><li class=\"level-x level-4\"><a class=\"menu__link\" href=\"/c/', page_id, '\">C</a></li></ul></nav>')"
)


@query("""SELECT url, s.* FROM (SELECT url, unnest([{pos: 0, level: 1, href: '/a', text: 'A', is_category: true, is_current: false}, {pos: 1, level: 2, href: '/b', text: concat('B ', page_id), is_category: false, is_current: true},
{pos: 2, level: 4, href: concat('/c/', page_id), text: 'C', is_category: false, is_current: false}]) AS s FROM pages)""")
def sidebar_menus(t: Tables) -> DataFrame:
    """The first link of each target with a level, in the site's own menu."""
    return tree.sidebar_items(t.pages.select("url", F.expr(MENU).alias("html")))


def _menu_page(current: str, items: list[tuple[int, str, bool]]) -> str:
    links = "".join(f'<li class="level-{n}"><a class="menu__link{" menu__link--sublist" * more}" {"aria-current=page" if href == current else ""} href="{href}">{href}</a></li>' for n, href, more in items)
    return f'<nav class="menu"><ul>{links}</ul></nav>'


@query("SELECT * FROM (VALUES (0::BIGINT, 'https://h/a', NULL::BIGINT, 0, 1), (1, 'https://h/a/1', 0, 0, 2), (2, 'https://h/a/2', 0, 0, 2), (3, 'https://h/a/2/x', 2, 0, 3), (4, 'https://h/b', NULL, 1, 1)) v(node_id, url, parent_id, root_index, depth)")
def crawled_tree(t: Tables) -> DataFrame:
    """A small site: categories are entered, a page met twice stays where it was first."""
    top = [(1, "/top", True), (2, "/a", True), (2, "/b", False)]
    inner = [(1, "/top", True), (2, "/a", True), (3, "/a/1", False), (3, "/a/2", True), (2, "/b", False)]
    site = {
        "https://h/top": _menu_page("/top", top), "https://h/a": _menu_page("/a", inner),
        "https://h/a/2": _menu_page("/a/2", [(2, "/a", True), (3, "/a/1", False), (3, "/a/2", True), (4, "/a/2/x", False), (4, "/a/1", False), (2, "/b", False)]),
    }
    return tree.nodes(t.spark, tree.crawl("top", "https://h/top", site.get, set())).select("node_id", "url", "parent_id", "root_index", "depth")


def _place_tree(t: Tables) -> DataFrame:
    """Regions as roots, their nations below them."""
    path = F.format_string("%06d", F.col("n_regionkey"))
    roots = t.region.select(F.lit(0).cast("long").alias("node_id"), F.concat(F.lit("https://h/r"), "r_regionkey").alias("url"), F.lit(None).cast("long").alias("parent_id"), F.col("r_regionkey").cast("int").alias("root_index"), F.lit(1).alias("depth"), F.format_string("%06d", "r_regionkey").alias("path"))
    leaves = t.nation.select(F.lit(1).cast("long"), F.concat(F.lit("https://h/n"), "n_nationkey"), F.lit(0).cast("long"), F.col("n_regionkey").cast("int"), F.lit(2), F.concat(path, F.lit("/"), F.format_string("%06d", "n_nationkey")))
    return roots.union(leaves)


PLACE_BODY = "concat('<div><p><a href=\"https://h/x\">x</a></p></div>', {nl}, {nl})".format(nl=NL)


@query(f"""WITH r AS (SELECT r_regionkey AS k, concat('https://h/r', r_regionkey) AS url, r_name AS name FROM region),
own AS (SELECT k, '' AS path, concat('<h1>', name, '</h1>', {NL}, {NL}, '<p><strong>Path:</strong> <a href=''', url, '''>', name, '</a></p>', {NL}, {NL}, {PLACE_BODY}) AS text FROM r
UNION ALL SELECT r.k, lpad(n_nationkey::VARCHAR, 6, '0'), concat('<h2>https://h/n', n_nationkey, '</h2>', {NL}, {NL}, '<p><strong>Path:</strong> <a href=''', url, '''>', name, '</a> > <a href=''https://h/n', n_nationkey, '''>https://h/n', n_nationkey, '</a></p>', {NL}, {NL}, '', {NL}, {NL}) FROM nation JOIN r ON n_regionkey = k)
SELECT k::INT AS root_index, substr(sha1(r.url), 1, 10) || '_' || trim(regexp_replace(name, '[^-a-zA-Z0-9_]', '_', 'g'), '_') || '.html' AS filename, md5(string_agg(text, '' ORDER BY path)) AS html_md5 FROM own JOIN r USING (k) GROUP BY 1, 2""")
def rendered_places(t: Tables) -> DataFrame:
    """A document a region: its page, cleaned, with absolute links; its nations, whose pages weren't fetched, as headings."""
    page = F.concat(F.lit('<html><nav>no</nav><div class="theme-doc-markdown markdown" id="i"><h1 class="t">'), "r_name", F.lit('</h1><svg></svg><p id="q"><a class="c" href="/x">x</a></p></div></html>'))
    pages = t.region.select(F.concat(F.lit("https://h/r"), "r_regionkey").alias("url"), page.alias("html"))
    return tree.render_roots(_place_tree(t), pages).select("root_index", "filename", F.md5("html").alias("html_md5"))


@query("SELECT n_regionkey::INT AS root_index, count(*) + 1 AS n FROM nation WHERE n_regionkey IN (1, 3) GROUP BY 1")
def selected_roots(t: Tables) -> DataFrame:
    """Roots by a list of numbers, given twice and out of order."""
    picked = tree.select_roots(_place_tree(t), tree.parse_root_indices(" 3, 1,3", t.region.count()))
    return picked.groupBy("root_index").agg(F.count(F.lit(1)).alias("n"))


# *** code and descriptions

CODED = "concat('`fooBar ', CASE WHEN doc_id % 5 = 0 THEN 'mine' ELSE 'my_name' END, '`', repeat(' word', CAST(doc_id % 20 AS INT)))"


def _coded(t: Tables) -> DataFrame:
    return t.documents.select(
        F.expr("concat('c', doc_id)").alias("id"), F.expr("CASE WHEN doc_id % 2 = 0 THEN 'companion_reference' ELSE 'official' END").alias("source_type"), F.expr(CODED).alias("content"),
        F.expr("concat('T', doc_id)").alias("title"), F.lit("Sec").alias("section_heading"), F.lit("B").alias("breadcrumb"),
    )


@query("SELECT concat('c', doc_id) AS id FROM documents WHERE doc_id % 2 = 0 AND doc_id % 20 <= 9 AND doc_id % 5 <> 0")
def eligible_chunks(t: Tables) -> DataFrame:
    """Companion chunks, at least three tenths of them code, with two identifiers or more."""
    return cache.eligible(_coded(t), QuarterTokenizer()).select("id")


@query("SELECT concat('c', doc_id) AS id, least(1.0, 4.0::DOUBLE / (4 + doc_id % 20)) AS ratio, CASE WHEN doc_id % 5 = 0 THEN 'fooBar' ELSE 'fooBar my_name' END AS names FROM documents")
def code_shares(t: Tables) -> DataFrame:
    ratio = F.udf(lambda text: I.code_ratio(text, QuarterTokenizer()), "double", useArrow=True)
    found = cache.with_identifiers(_coded(t))
    return found.select("id", ratio("content").alias("ratio"), F.array_join("identifiers", " ").alias("names"))


@query(r"""SELECT concat('c', doc_id) AS id, array_to_string([concat('```py', chr(10), 'a = ', doc_id, chr(10), '```'), '`one`', '`two three`', concat('~~~~', chr(10), 'open ', doc_id, chr(10), '~~~', chr(10), '`in`')], ' / ') AS segments FROM documents""")
def code_segments(t: Tables) -> DataFrame:
    """Fenced blocks, inline code outside of them, and a fence that a shorter one doesn't close."""
    text = _text("'see|```py|a = '", "doc_id", "'|```|`one` and `two three` or `not'", "chr(10)", "'closed`|~~~~|open '", "doc_id", "'|~~~|`in`'")
    found = F.udf(I.code_segments, "array<string>", useArrow=True)
    return t.documents.select(F.expr("concat('c', doc_id)").alias("id"), F.array_join(found(F.expr(text)), " / ").alias("segments"))


MARKUP = "concat('<a:root kind=\"k\" type=\"T', doc_id % 7, '\"><b type=\"T2\"/><c xsi:type=\"T1\" n=\"x:y=1\"></c><r', doc_id, '></r', doc_id, '></a:root> text <z xmlns:q=\"u\"/>')"


@query("""SELECT doc_id, 'a:root z' AS roots, array_to_string(list_filter([concat('T', doc_id % 7), CASE WHEN doc_id % 7 <> 2 THEN 'T2' END, CASE WHEN doc_id % 7 <> 1 THEN 'T1' END], lambda x: x IS NOT NULL), ' ') AS types, 'a: xsi: q:' AS prefixes,
array_to_string(list_sort(list_distinct(['a:root', 'a:', 'b', 'c', 'xsi:', 'z', 'q:', concat('r', doc_id), 'T1', 'T2', concat('T', doc_id % 7)])), ' ') AS names FROM documents""")
def structural_facts(t: Tables) -> DataFrame:
    """Outermost elements, type values and prefixes in order; all names of the markup, sorted."""
    found = F.udf(I.facts, "roots array<string>, types array<string>, prefixes array<string>")
    names = F.udf(I.identifiers, "array<string>", useArrow=True)
    made = t.documents.select("doc_id", F.expr(MARKUP).alias("m")).select("doc_id", found("m").alias("f"), names("m").alias("names"))
    return made.select("doc_id", *[F.array_join(F.col("f")[k], " ").alias(k) for k in ("roots", "types", "prefixes")], F.array_join("names", " ").alias("names"))


@query("SELECT concat('c', doc_id) AS id, doc_id % 5 IN (0, 1) AS raw FROM documents")
def raw_components(t: Tables) -> DataFrame:
    """Serialised components: prefixed, or plain with a telling attribute by name; not by an attribute's value, nor other words."""
    content = "CASE doc_id % 5 WHEN 0 THEN 'x <ns:Component/> y' WHEN 1 THEN '<Component a=\"1\" componentId=\"z\">' WHEN 2 THEN '<Component other=\"type=1\">' WHEN 3 THEN 'a Component of it' ELSE '<Components type=\"t\">' END"
    return t.documents.select(F.expr("concat('c', doc_id)").alias("id"), validate.raw_component(F.expr(content)).alias("raw"))


SAID = {
    0: "Topic one explains fooBar.", 1: "One. Two Topic. Three. Four.", 2: "Nothing here about it.", 3: "Topic with <b>markup</b>.", 4: "Topic names otherThing too.", 5: "Topic " + "word " * 130,
}


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'shape: 4 sentences instead of 1 to 3|mandatory: topic ''Topic'' isn''t in the first sentence' WHEN 2 THEN 'mandatory: topic ''Topic'' isn''t in the first sentence'
WHEN 3 THEN 'shape: markup|introduced_identifier: ''b'' isn''t in the source' WHEN 4 THEN 'introduced_identifier: ''otherThing'' isn''t in the source' ELSE 'shape: 132 tokens, 128 are allowed' END AS errors FROM documents""")
def description_errors(t: Tables) -> DataFrame:
    """Descriptions that break a rule each: shape, topic, markup, invented identifiers, length."""
    counter = QuarterTokenizer()
    judge = F.udf(lambda k: "|".join(I.description_errors(SAID[k], document="uses fooBar", known=["fooBar"], topic="Topic", about=I.facts("uses fooBar"), tokenizer=counter)), "string")
    return t.documents.select("doc_id", judge((F.col("doc_id") % 6).cast("int")).alias("errors"))


RECIPE = {"prompt_version": "1", "system_prompt": "s", "user_prompt_template": "{topic}|{raw_document}", "model": "m"}


@query("""SELECT concat('c', doc_id) AS id, CASE WHEN doc_id % 3 = 0 THEN 'raw_fallback' ELSE 'ok' END AS status, CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('T', doc_id, ' uses fooBar.') END AS description,
CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'm' END AS returned_model_id FROM documents WHERE doc_id % 2 = 0 AND doc_id % 4 = 0""")
def generated_descriptions(t: Tables) -> DataFrame:
    """Descriptions for the keys that a cache of every other even chunk lacks; every third answer breaks a rule at each try."""
    recipe = cache.contract(**RECIPE)
    wanted = cache.keyed(_coded(t).where("source_type = 'companion_reference'"), recipe)
    held = wanted.where("int(substring(id, 2)) % 4 <> 0").select("cache_key")

    def call(system: str, prompt: str, model: str) -> tuple[str, str]:
        topic = prompt.split("|")[0]
        return model, "It uses otherThing." if int(topic[1:]) % 3 == 0 else f"{topic} uses fooBar."

    made = cache.generate(cache.missing(wanted, held), recipe, call, QuarterTokenizer())
    return made.join(wanted.select("cache_key", "id"), "cache_key").select("id", "status", "description", "returned_model_id")


# *** scalars of the contract


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Docs' ELSE 'Docs' END AS category, CASE WHEN doc_id % 4 = 2 THEN concat('a', doc_id) END AS area,
CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Docs' WHEN 2 THEN 'Leaf' ELSE 'Leaf' END AS leaf FROM documents""")
def breadcrumb_parts(t: Tables) -> DataFrame:
    crumb = F.expr("CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Docs' WHEN 2 THEN concat('Docs > a', doc_id, ' > Leaf') ELSE 'Docs >  > Leaf' END")
    return t.documents.select("doc_id", C.category(crumb).alias("category"), C.area(crumb).alias("area"), C.last_segment(crumb).alias("leaf"))


@query("SELECT doc_id, concat('https://h/r/blob/', sha1(text), '/d/', doc_id, '.md') AS address FROM documents")
def source_addresses(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", C.fill_template(F.lit("https://h/r/blob/{commit}/{path}"), F.sha1("text"), F.concat(F.lit("d/"), "doc_id", F.lit(".md"))).alias("address"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'status 404' WHEN 1 THEN 'empty body' WHEN 4 THEN NULL ELSE 'HTML' END AS verdict FROM documents WHERE doc_id % 5 <> 4")
def refused_responses(t: Tables) -> DataFrame:
    """Responses that can't be Markdown: by status, by a blank body, by content type, by their first characters."""
    from sparkloom.sources import readers

    text = "CASE doc_id % 5 WHEN 1 THEN concat(chr(10), ' ') WHEN 3 THEN concat(chr(10), ' <!DocType HTML><p>') ELSE '# ok' END"
    fetched = t.documents.select(
        F.col("doc_id").cast("string").alias("url"), F.expr("CASE WHEN doc_id % 5 = 0 THEN 404 ELSE 200 END").alias("status"), F.expr("CASE WHEN doc_id % 5 = 2 THEN 'Text/HTML; charset=x' ELSE 'text/plain' END").alias("content_type"), F.expr(text).alias("text")
    )
    found = readers.reject_non_markdown(fetched)
    return found.select(F.col("url").cast("long").alias("doc_id"), F.when(F.col("error").rlike("(?i)html"), "HTML").otherwise(F.col("error")).alias("verdict"))


@query("""SELECT doc_id, doc_id % 4 = 1 OR doc_id % 4 = 2 AS better, CASE doc_id % 4 WHEN 0 THEN 'section' WHEN 1 THEN 'byte' END AS kind, CASE doc_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS status_rank FROM documents""")
def evaluation_scalars(t: Tables) -> DataFrame:
    """Improvement by a margin, misses on either side; anchors by heading, by bytes, or neither; the order of statuses."""
    k = F.col("doc_id") % 4
    candidate = F.when(k == 0, None).when(k == 1, 0.3).when(k == 2, 0.3).otherwise(F.lit(0.37))
    baseline = F.when(k == 1, 0.4).when(k == 3, 0.4)
    kind = C.anchor_kind(F.when(k == 2, 9).otherwise(1), F.lit(5), F.when(k == 0, " H ").when(k == 3, " "))
    status = F.when(k == 0, "ok").when(k == 1, "low_confidence").when(k == 2, "no_match").otherwise("other")
    return t.documents.select("doc_id", C.improved(candidate, baseline).alias("better"), kind.alias("kind"), C.status_rank(status).alias("status_rank"))


@query("SELECT concat('c', doc_id) AS id, (250 + doc_id % 10)::INT AS tokens FROM documents WHERE doc_id % 10 > 4")
def over_budget(t: Tables) -> DataFrame:
    plan = t.documents.select(F.expr("concat('c', doc_id)").alias("id"), F.expr("repeat('abc ', CAST(250 + doc_id % 10 AS INT))").alias("embedding_input"))
    return validate.over_budget(plan)


@query("SELECT candidate, (SELECT count(*) FROM documents WHERE doc_id % 2 = 0) AS with_spans, (SELECT count(*) FROM documents) AS n FROM (VALUES ('c0'), ('b5')) v(candidate)")
def lineage_errors(t: Tables) -> DataFrame:
    """Chunks of which every other one has spans fit neither lineage."""
    own = t.documents.select(F.expr("CASE WHEN doc_id % 2 = 0 THEN concat('r', doc_id) END").alias("source_record_id"))
    return validate.lineage_errors(own, "c0").unionByName(validate.lineage_errors(own, "b5"))


@query("SELECT md5(url) AS id, 'x' AS title, url AS page_key, 3 AS chunk_index, '' AS raw_url FROM pages")
def metadata_fields(t: Tables) -> DataFrame:
    """Scalars of a chunk's metadata; nulls are empty strings."""
    from sparkloom.operators import index

    blank = {c: F.lit(None).cast("string") for c in index.SCALARS}
    own = blank | {"title": F.lit("x"), "page_key": F.col("url"), "chunk_index": F.lit(3), "token_estimate": F.lit(1)}
    made = index.metadata(t.pages.select(F.md5("url").alias("id"), *[v.alias(k) for k, v in own.items()]))
    return made.select("id", *[F.col("metadata")[k].alias(k) for k in ("title", "page_key", "chunk_index", "raw_url")])


