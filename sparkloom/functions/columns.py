"""Scalar functions as native Columns: they stay in whole-stage code generation and have plain SQL counterparts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.identifiers import WORD_FORMS

#: Unicode white space as str.split sees it.
BLANK = r"(?U)[\s\x1c-\x1f]"
DENIED_NAMES = ("readme.md", "claude.md")
STATUS_ORDER = {name: rank for rank, name in enumerate("no_match low_confidence ok".split())}
MISS_RANK = 99


def strip(text: Column) -> Column:
    """Without Unicode white space at either end (Spark's trim takes plain spaces only)."""
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def squeeze(text: Column) -> Column:
    """White space runs as single spaces, none at the ends."""
    return strip(F.regexp_replace(text, rf"{BLANK}+", " "))


def token_estimate(text: Column) -> Column:
    """A quarter of the code points, rounded down."""
    return F.floor(F.length(text) / 4).cast("int")


def wordpiece_count(text: Column) -> Column:
    """Deterministic stand-in for WordPiece: a quarter of each word's code points, rounded up."""
    words = F.filter(F.split(text, rf"{BLANK}+"), lambda w: w != "")
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.ceil(F.length(w) / 4).cast("int"))


def page_key(url: Column, stem: Column) -> Column:
    """URL without fragment, query and trailing slashes; ``file:<stem>`` where nothing is left."""
    bare = F.substring_index(F.substring_index(strip(url), "#", 1), "?", 1)
    return F.coalesce(F.nullif(F.regexp_replace(bare, "/+$", ""), F.lit("")), F.concat(F.lit("file:"), stem))


def category(breadcrumb: Column) -> Column:
    """Text before the first `` > ``; Unknown for an empty breadcrumb."""
    return F.when(F.coalesce(breadcrumb, F.lit("")) == "", F.lit("Unknown")).otherwise(strip(F.substring_index(breadcrumb, " > ", 1)))


def last_segment(breadcrumb: Column) -> Column:
    return strip(F.substring_index(breadcrumb, " > ", -1))


def area(breadcrumb: Column) -> Column:
    """Middle segment of a breadcrumb of three or more; null otherwise or where it is blank."""
    parts = F.split(breadcrumb, " > ")
    return F.when(F.size(parts) >= 3, F.nullif(strip(F.element_at(parts, 2)), F.lit("")))


def _identifier(stem: Column, longest: int) -> Column:
    base = F.lower(F.regexp_replace(F.regexp_replace(stem, r"[^\w]", "_"), "^_+|_+$", ""))
    return F.when(F.length(base) > longest, F.regexp_replace(F.substring(base, 1, longest), "_+$", "")).otherwise(base)


def chunk_id(stem: Column, index: Column) -> Column:
    return F.format_string("%s_%03d", _identifier(stem, 60), index)


def companion_chunk_id(path: Column, index: Column) -> Column:
    """Carries a hash of the whole path, since stems repeat across folders."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=[^.])\.[^.]*$", "")
    return F.format_string("companion_%s_%s_%03d", _identifier(stem, 40), F.substring(F.sha1(path), 1, 12), index)


def output_filename(title: Column, url: Column) -> Column:
    """Ten digits of the URL's SHA-1 and the title's safe form."""
    safe = F.regexp_replace(F.regexp_replace(title, r"[^-\w]", "_"), "^_+|_+$", "")
    return F.concat(F.substring(F.sha1(url), 1, 10), F.lit("_"), F.coalesce(F.nullif(safe, F.lit("")), F.lit("document")), F.lit(".html"))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def cache_key(input_sha: Column, contract_sha: Column) -> Column:
    """SHA-256 of both digests with a NUL between."""
    return F.sha2(F.concat(input_sha, F.lit("\x00"), contract_sha), 256)


def generation_input_json(content: Column, title: Column, heading: Column, breadcrumb: Column, source_type: Column, identifiers: Column) -> Column:
    """Canonical JSON (sorted keys, compact, unescaped) of what a description is generated from."""
    fields = {"breadcrumb": breadcrumb, "identifiers": F.array_sort(identifiers), "raw_document": content, "section_heading": heading, "source_type": source_type, "title": title}
    return F.to_json(F.struct(*[F.coalesce(c, F.lit("")).alias(k) if k != "identifiers" else c.alias(k) for k, c in sorted(fields.items())]))


def is_pinned_commit(commit: Column) -> Column:
    return F.coalesce(commit.rlike("^[0-9a-f]{40}$"), F.lit(False))


def is_denied_path(path: Column, names: Sequence[str] = DENIED_NAMES) -> Column:
    """Unsafe, non-canonical or excluded repository paths; null counts as denied."""
    base = F.lower(F.substring_index(path, "/", -1))
    odd = F.exists(F.split(path, "/"), lambda part: part.isin("", ".", ".."))
    return F.coalesce((path == "") | path.startswith("/") | path.contains("\\") | odd | base.endswith(".sh") | base.isin(*names), F.lit(True))


def fill_template(template: Column, commit: Column, path: Column) -> Column:
    return F.replace(F.replace(template, F.lit("{commit}"), commit), F.lit("{path}"), path)


def looks_like_markdown(text: Column, content_type: Column) -> Column:
    """No HTML by its type or its first characters."""
    head = F.lower(F.substring(F.regexp_replace(text, rf"^{BLANK}+", ""), 1, 512))
    return ~F.lower(F.coalesce(content_type, F.lit(""))).contains("text/html") & ~head.startswith("<!doctype html") & ~head.startswith("<html")


def page_norm(text: Column) -> Column:
    """Lower case, ASCII letters and digits only: survives URL encoding."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def page_matches(page_match: Column, key: Column) -> Column:
    return page_norm(key).contains(page_norm(page_match))


def group_hit(page_match: Column, markers: Column, key: Column, content: Column) -> Column:
    """The page matches, and there are no markers or one of them stands in the content."""
    marked = (F.size(markers) == 0) | F.exists(markers, lambda m: content.contains(m))
    return page_matches(page_match, key) & marked


def group_identity(page_match: Column, markers: Column) -> Column:
    """Page and sorted markers, angle brackets around a marker aside."""
    bare = F.array_sort(F.transform(markers, lambda m: F.regexp_replace(F.regexp_replace(strip(m), "^<+", ""), ">+$", "")))
    return F.to_json(F.struct(page_match.alias("page"), bare.alias("markers")))


def heading_norm(text: Column) -> Column:
    return F.lower(squeeze(F.coalesce(text, F.lit(""))))


def spans_overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Half-open intervals share a byte position."""
    return (a_start < b_end) & (b_start < a_end)


def improved(candidate: Column, baseline: Column, margin: float = 0.05) -> Column:
    """A miss never improves; a baseline miss is always improved upon."""
    return F.when(candidate.isNull(), False).when(baseline.isNull(), True).otherwise(baseline - candidate >= margin)


def search_status(best_distance: Column, limit: float = 0.45) -> Column:
    return F.when(best_distance.isNull(), "no_match").when(best_distance <= limit, "ok").otherwise("low_confidence")


def status_rank(status: Column) -> Column:
    found = F.lit(0)
    for name, rank in STATUS_ORDER.items():
        found = F.when(status == name, rank).otherwise(found)
    return found


def anchor_kind(start: Column, end: Column, heading: Column) -> Column:
    """section, byte, or null for an anchor that is neither."""
    return F.when(strip(heading) != "", "section").when(heading.isNull() & (end >= start), "byte")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def sentences(text: Column) -> Column:
    """Pieces between sentence ends: white space after a full stop, exclamation or question mark."""
    return F.filter(F.split(text, r"(?U)(?<=[.!?])\s+"), lambda s: strip(s) != "")


def word_identifiers(text: Column) -> Column:
    """Sorted distinct dotted paths, underscore names and both camel-case forms."""
    found = [F.regexp_extract_all(text, F.lit("(?U)" + f), F.lit(0)) for f in WORD_FORMS]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))
