"""From pages and Markdown files to chunks: sections, the quarter-length chunker, and the exact-budget chunker."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions import columns as C
from sparkloom.functions import header, html, markdown, splitter
from sparkloom.functions.tokenizer import BUDGET, Counter, QuarterTokenizer
from sparkloom.operators.rows import Row, flat_map, numbered, running_bytes, spread
from sparkloom.session import written

MIN_TOKENS = 100
MAX_TOKENS = 1200
OFFICIAL, COMPANION = header.OFFICIAL, header.COMPANION
COMPANION_CATEGORY = "Companion Reference"
LABELS = "title section_heading breadcrumb source_url page_key".split()
BLANK_PROVENANCE = dict.fromkeys("upstream_repo upstream_commit source_path raw_url latest_url".split(), "")


def html_sections(pages: DataFrame, *, file_col: str = "file", html_col: str = "html", element: str | None = None, classes: str | None = None, assets: bool = True) -> DataFrame:
    """Sections of each page, in order. ``element`` narrows a page to its first such element; assets=False drops scripts and styles first."""

    def parse(row: Row) -> Iterator[Row]:
        root = html.parse(row["html"] or "")
        if not assets:
            html.drop_assets(root)
        if element:
            found = html.container(root, element, classes)
            root = html.Element("#root", children=found.children if found else [])
            for child in root.children:
                child.parent = root
        sections = html.sections(root)
        title = html.page_title(sections, row["file"])
        for pos, s in enumerate(sections):
            yield {
                "file": row["file"], "pos": pos, "heading_tag": s.tag, "heading_text": s.heading, "breadcrumb": s.breadcrumb, "source_url": s.url,
                "content_text": html.text_of(s.nodes), "content_html": html.html_of(s.nodes), "page_title": title,
            }

    return flat_map(spread(pages.select(F.col(file_col).cast("string").alias("file"), F.col(html_col).alias("html"))), parse, schemas.HTML_SECTION)


def markdown_sections(files: DataFrame, *, curated: bool = False) -> DataFrame:
    """Sections of each Markdown file with byte spans. ``curated`` applies the row's sections and drop_sections lists."""

    def parse(row: Row) -> Iterator[Row]:
        found = markdown.sections(row["text"] or "")
        if curated:
            found = markdown.curate(found, row.get("sections"), row.get("drop_sections"))
        for pos, s in enumerate(found):
            yield {"path": row["path"], "pos": pos, "level": s.level, "heading": s.heading, "body": s.body, "body_start_byte": s.start, "body_end_byte": s.end}

    return flat_map(files, parse, schemas.MARKDOWN_SECTION)


# *** the quarter-length chunker


def merge_small(drafts: list[dict[str, Any]], least: int) -> list[dict[str, Any]]:
    """Sections too small to stand alone join the one before, on the same page; a small last one too, without a say in the heading."""
    out: list[dict[str, Any]] = []

    def absorb(into: dict[str, Any], more: dict[str, Any]) -> None:
        for name in ("text", "html"):
            into[name] = f"{into[name]}\n{more[name]}".strip()

    for draft in map(dict, drafts):
        before = out[-1] if out else None
        if before and before["page_key"] == draft["page_key"] and len(before["text"]) // 4 < least:
            empty = not before["text"].strip()
            absorb(before, draft)
            if draft["heading"] and (empty or not before["heading"]):
                before["heading"] = draft["heading"]
            if draft["breadcrumb"] and not before["breadcrumb"]:
                before["breadcrumb"], before["source_url"] = draft["breadcrumb"], draft["source_url"]
        else:
            out.append(draft)
    if len(out) > 1 and out[-2]["page_key"] == out[-1]["page_key"] and len(out[-1]["text"]) // 4 < least:
        last = out.pop()
        absorb(out[-1], last)
    return out


def cut_large(drafts: list[dict[str, Any]], most: int) -> Iterator[dict[str, Any]]:
    """Chunks over the limit are packed anew from their HTML, each piece under the heading."""
    for draft in drafts:
        if len(draft["text"]) // 4 <= most:
            yield draft
            continue
        for piece in html.split_blocks(draft["html"], most):
            text = html.plain_text(piece)
            yield draft | {"html": piece, "text": "\n".join(x for x in (draft["heading"], text) if x)}


def _page_key(url: str, stem: str) -> str:
    return url.strip().split("#", 1)[0].split("?", 1)[0].rstrip("/") or f"file:{stem}"


def _stem(file: str) -> str:
    return PurePosixPath(file).stem


def chunk_pages(pages: DataFrame, *, least: int = MIN_TOKENS, most: int = MAX_TOKENS, element: str | None = None, classes: str | None = None, file_col: str = "file", html_col: str = "html") -> DataFrame:
    """Chunks of HTML pages by quarter-length estimates, numbered within their page. One pass over the pages, then two counts."""

    def parse(row: Row) -> Iterator[Row]:
        root = html.parse(row["html"] or "")
        if element:
            found = html.container(root, element, classes)
            root = html.Element("#root", children=found.children if found else [])
            for child in root.children:
                child.parent = root
        sections = html.sections(root)
        title = html.page_title(sections, row["file"])
        drafts = []
        for s in sections:
            text = html.text_of(s.nodes)
            shown = s.heading if s.tag != "h1" else ""
            drafts.append({
                "heading": s.heading, "breadcrumb": s.breadcrumb, "source_url": s.url, "page_key": _page_key(s.url, _stem(row["file"])),
                "text": "\n".join(x for x in (shown, text) if x), "html": html.html_of(s.nodes),
            })
        for i, d in enumerate(cut_large(merge_small(drafts, least), most)):
            if d["text"].strip():
                yield {"file": row["file"], "ord": i, "stem": _stem(row["file"]), "page_title": title, "heading": d["heading"], "breadcrumb": d["breadcrumb"], "source_url": d["source_url"], "page_key": d["page_key"], "content": d["text"], "content_html": d["html"]}

    drafts = flat_map(
        spread(pages.select(F.col(file_col).cast("string").alias("file"), F.col(html_col).alias("html"))), parse,
        "file string, ord int, stem string, page_title string, heading string, breadcrumb string, source_url string, page_key string, content string, content_html string",
    )
    return numbered(_official(drafts), "page_key", "file", "ord")


def _official(drafts: DataFrame) -> DataFrame:
    """Identity, titles and blank provenance, as native expressions."""
    crumb = F.col("breadcrumb")
    title = F.when(crumb != "", F.coalesce(F.nullif(C.last_segment(crumb), F.lit("")), F.col("page_title"))).otherwise(F.col("page_title"))
    return drafts.withColumn("title", title).select(
        "file", "ord", C.chunk_id(F.col("stem"), F.col("ord")).alias("id"), "title", F.coalesce(F.nullif(F.col("heading"), F.lit("")), F.col("title")).alias("section_heading"),
        "breadcrumb", "source_url", "page_key", C.category(crumb).alias("category"), "content", "content_html", C.token_estimate(F.col("content")).alias("token_estimate"),
        F.lit(OFFICIAL).alias("source_type"), F.lit(OFFICIAL).alias("verification_status"), *[F.lit("").alias(k) for k in BLANK_PROVENANCE],
    )


def _companion_labels(row: Row, found: list[markdown.Section]) -> tuple[str, str]:
    title = row["title"] or markdown.title_of(found) or _stem(row["path"])
    return title, " > ".join(x for x in (COMPANION_CATEGORY, row["area"], title) if x)


def chunk_markdown(files: DataFrame, *, least: int = MIN_TOKENS, most: int = MAX_TOKENS) -> DataFrame:
    """Chunks of verified Markdown files (schemas.SOURCE_FILE with text, repo, commit and three URLs) by quarter-length estimates."""

    def parse(row: Row) -> Iterator[Row]:
        found = markdown.sections(row["text"])
        title, crumb = _companion_labels(row, found)
        key = f"companion://{(row['upstream_repo'] or '').strip('/')}/{row['path']}"
        drafts = []
        for s in markdown.curate(found, row["sections"], row["drop_sections"]):
            body = markdown.strip_markup_blocks(s.body) if row["strip_xml_blocks"] else s.body
            shown = s.heading if s.level >= 2 else ""
            text = "\n".join(x for x in (shown, body) if x.strip()) if shown else body
            drafts.append({"heading": s.heading, "breadcrumb": crumb, "source_url": row["blob_url"] or "", "page_key": key, "text": text, "html": markdown.render(body)})
        kept = [d for d in cut_large(merge_small(drafts, least), most) if d["text"].strip()]
        for i, d in enumerate(kept):
            yield {"file": row["path"], "ord": i, "title": title, "heading": d["heading"] or title, "breadcrumb": crumb, "source_url": d["source_url"], "page_key": key, "content": d["text"], "content_html": d["html"], **_provenance(row)}

    drafts = flat_map(spread(files), parse, "file string, ord int, title string, heading string, breadcrumb string, source_url string, page_key string, content string, content_html string, upstream_repo string, upstream_commit string, raw_url string, latest_url string")
    named = drafts.select(
        "file", "ord", C.companion_chunk_id(F.col("file"), F.col("ord")).alias("id"), "title", F.col("heading").alias("section_heading"), "breadcrumb", "source_url", "page_key",
        F.lit(COMPANION_CATEGORY).alias("category"), "content", "content_html", C.token_estimate(F.col("content")).alias("token_estimate"),
        F.lit(COMPANION).alias("source_type"), F.lit("companion_unverified").alias("verification_status"), "upstream_repo", "upstream_commit", F.col("file").alias("source_path"), "raw_url", "latest_url",
    )
    return numbered(named, "page_key", "file", "ord")


def _provenance(row: Row) -> dict[str, str]:
    return {k: row.get(k) or "" for k in ("upstream_repo", "upstream_commit", "raw_url", "latest_url")}


# *** the exact-budget chunker


def fence_reserve(text: str, tokenizer: Counter) -> int:
    """Tokens that a fragment's own opening and closing fence lines may take, at worst."""
    return max((tokenizer.count(line.strip()) + tokenizer.count(m[0] * m[1]) for line in text.split("\n") if (m := markdown.fence(line))), default=0)


def section_chunks(
    payload: str, *, heading: str, title: str, breadcrumb: str, source_type: str, base: int, record: str, path: str, tokenizer: Counter,
    rewritten: tuple[int, int] | None = None, budget: int = BUDGET,
) -> list[dict[str, Any]]:
    """Chunks of one section whose header, heading and text together stay within the budget.

    ``rewritten`` is the original span of a payload that isn't the source's own text any more; its chunks carry that.
    """
    head = header.build(source_type, title, breadcrumb, heading, tokenizer)
    reserved = head.tokens + tokenizer.count(heading) + fence_reserve(payload, tokenizer)
    if reserved >= budget:
        raise ValueError(f"{path}: header, heading {heading!r} and fence lines take {reserved} of {budget} tokens, which leaves none for text")
    fragments = splitter.split(payload, base=base, budget=budget - reserved, tokenizer=tokenizer, path=path)
    splitter.check_tiling(payload, base, fragments, path)
    whole = tokenizer.count(payload)
    out = []
    for f in fragments:
        body = f.body()
        content = f"{heading}\n{body}" if body.strip() else heading
        embedded = f"{head.text}\n{content}" if head.text else content
        if (size := tokenizer.count(embedded)) > budget:
            raise RuntimeError(f"{path}: a chunk of {heading!r} has {size} tokens with its header, {budget} are allowed")
        start, end = rewritten or (f.start, f.end)
        out.append({
            "content": content, "content_html": markdown.render(body) if body.strip() else "", "token_estimate": len(content) // 4, "s6_header": head.text,
            "content_token_count": tokenizer.count(content), "source_token_count": whole, "embedding_token_count": size,
            "source_record_id": record, "source_start_byte": start, "source_end_byte": end,
            "synthetic_wrapper_metadata": dict(fence_open=f.fence_open, fence_close=f.fence_close, stripped_xml=rewritten is not None, spans=[[start, end]], heading_line=True),
        })
    return out


def span_chunk_pages(pages: DataFrame, tokenizer: Counter | None = None, *, element: str | None = None, classes: str | None = None, file_col: str = "file", html_col: str = "html") -> DataFrame:
    """Exact-budget chunks of HTML pages. A page's record is its sections, heading line and text, blank lines between.

    Sections' places in their record are a running sum over small rows; text then goes through the splitter in place.
    Sections and chunks are written down, since numbering reads its rows twice: a page is parsed and split once.
    """
    counter = tokenizer or QuarterTokenizer()
    crumb = F.col("breadcrumb")
    title = F.when(crumb != "", F.coalesce(F.nullif(C.last_segment(crumb), F.lit("")), F.col("page_title"))).otherwise(F.col("page_title"))
    found = html_sections(pages, file_col=file_col, html_col=html_col, element=element, classes=classes, assets=False).where(F.col("content_text").rlike(r"(?U)\S"))
    stem = F.regexp_replace(F.substring_index("file", "/", -1), r"(?<=[^.])\.[^.]*$", "")
    named = (
        found.withColumn("title", title).withColumn("heading", F.coalesce(F.nullif(F.col("heading_text"), F.lit("")), F.col("title")))
        .withColumn("page_key", C.page_key(F.col("source_url"), stem)).withColumn("stem", stem)
        .withColumn("before", F.octet_length("heading") + 1).withColumn("taken", F.col("before") + F.octet_length("content_text") + 2)
    )
    placed = running_bytes(written(named, "sections"), "page_key", "taken", "file", "pos", name="ahead").withColumn("base", F.col("ahead") + F.col("before"))

    def parse(row: Row) -> Iterator[Row]:
        made = section_chunks(row["content_text"], heading=row["heading"], title=row["title"], breadcrumb="", source_type=OFFICIAL, base=row["base"], record=f"official:{row['page_key']}", path=row["file"], tokenizer=counter)
        if len(made) == 1:
            made[0]["content_html"] = row["content_html"]
        for part, chunk in enumerate(made):
            yield chunk | {k: row[k] for k in ("file", "pos", "stem", "title", "breadcrumb", "source_url", "page_key")} | {"part": part, "section_heading": row["heading"]}

    made = flat_map(placed, parse, f"file string, pos int, part int, stem string, title string, section_heading string, breadcrumb string, source_url string, page_key string, content string, content_html string, token_estimate int, {schemas.SPAN_FIELDS}")
    made = numbered(written(made, "chunks").withColumn("place", F.struct("pos", "part")), "file", "place", name="ord")
    out = made.select(
        "file", "ord", C.chunk_id(F.col("stem"), F.col("ord")).alias("id"), *LABELS, C.category(crumb).alias("category"), "content", "content_html",
        "token_estimate", F.lit(OFFICIAL).alias("source_type"), F.lit(OFFICIAL).alias("verification_status"), *[F.lit("").alias(k) for k in BLANK_PROVENANCE], *(x.split()[0] for x in _SPAN_NAMES),
    )
    return numbered(out, "page_key", "file", "ord")


_SPAN_NAMES = ["source_record_id", "source_start_byte", "source_end_byte", "source_token_count", "content_token_count", "embedding_token_count", "s6_header", "synthetic_wrapper_metadata"]


def span_chunk_markdown(files: DataFrame, tokenizer: Counter | None = None) -> DataFrame:
    """Exact-budget chunks of verified Markdown files; byte spans are of the file. Chunks are written down, as numbering reads them twice."""
    counter = tokenizer or QuarterTokenizer()

    def parse(row: Row) -> Iterator[Row]:
        found = markdown.sections(row["text"])
        title, crumb = _companion_labels(row, found)
        key = f"companion://{(row['upstream_repo'] or '').strip('/')}/{row['path']}"
        ord_ = 0
        for s in markdown.curate(found, row["sections"], row["drop_sections"]):
            body = markdown.strip_markup_blocks(s.body) if row["strip_xml_blocks"] else s.body
            if not body.strip():
                continue
            changed = body != s.body
            heading = s.heading or title
            for chunk in section_chunks(body, heading=heading, title=title, breadcrumb=crumb, source_type=COMPANION, base=0 if changed else s.start, record=key, path=row["path"], tokenizer=counter, rewritten=(s.start, s.end) if changed else None):
                yield chunk | {"file": row["path"], "ord": ord_, "title": title, "section_heading": heading, "breadcrumb": crumb, "source_url": row["blob_url"] or "", "page_key": key, **_provenance(row)}
                ord_ += 1

    made = flat_map(spread(files), parse, f"file string, ord int, title string, section_heading string, breadcrumb string, source_url string, page_key string, content string, content_html string, token_estimate int, upstream_repo string, upstream_commit string, raw_url string, latest_url string, {schemas.SPAN_FIELDS}")
    out = written(made, "chunks").select(
        "file", "ord", C.companion_chunk_id(F.col("file"), F.col("ord")).alias("id"), *LABELS, F.lit(COMPANION_CATEGORY).alias("category"), "content", "content_html",
        "token_estimate", F.lit(COMPANION).alias("source_type"), F.lit("companion_unverified").alias("verification_status"), "upstream_repo", "upstream_commit", F.col("file").alias("source_path"), "raw_url", "latest_url", *_SPAN_NAMES,
    )
    return numbered(out, "page_key", "file", "ord")


def union_corpora(official: DataFrame, companion: DataFrame) -> DataFrame:
    """Official chunks first, then companion ones; ``corpus_ord`` keeps that order."""
    return official.withColumn("corpus_ord", F.lit(0)).unionByName(companion.withColumn("corpus_ord", F.lit(1)), allowMissingColumns=True)
