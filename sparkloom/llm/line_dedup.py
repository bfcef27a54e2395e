"""Site-relative line deduplication, with DataFrame functions alone.

A page's lines are the trimmed, space-normalised pieces of its HTML between block-level tags, scripts, styles, heads
and comments aside. Within a host, a line that stands in more than ``max_ratio`` of the host's pages, on at least
``min_pages`` pages, is boilerplate and is dropped from all of them; other lines stay in order.

Defined results: a null or tagless html gives what text it has, a null one no line; a URL without a host belongs to
the host ``''``; repeated page rows count as pages each; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import attach, materialize, with_row_id

HIDDEN = r"(?is)<(script|style|head|noscript|template)\b.*?</\1\s*>|<!--.*?-->"
BLOCK = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|nav|article|section|header|footer|aside|main|body|html|form|blockquote|pre|dl|dt|dd|figure|figcaption|hr)\b[^>]*>"
#: Rows (host, digest) that go to every task at most: about 100 bytes each.
BROADCAST_ROWS = 50_000
TAG = r"<[/!?]?[a-zA-Z][^>]*>"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a leading ``www.``; '' if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def lines_of(html: Column) -> Column:
    """Array of the page's non-empty lines."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[\x20\x09-\x0D]+", " ")))
    return F.filter(trimmed, lambda x: x != "")


def dedup_lines(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_ratio: float = 0.1, min_pages: int = 3, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """page_id, host, text (kept lines, newline-joined), n_lines, n_dropped.

    Lines are counted as (host, digest) with map-side combining, so a hot host's lines spread over all tasks. The
    boilerplate found is written down and counted. Up to ``broadcast_rows`` of it, some MB, goes to every task and
    pages stay where they are; more of it meets the pages' digests in a salted join, and each page's own share of it
    comes back to the page by its place in the files.
    """
    lined = lambda df, *more: df.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), lines_of(F.col(html_col)).alias("lines"), *more)
    digests = F.transform(F.array_distinct("lines"), lambda x: F.md5(x))
    hosts = pages.select(host_of(F.col(url_col)).alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = lined(pages).select("host", F.explode(digests).alias("digest")).groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    common = materialize(seen.join(hosts, "host").where(F.col("n") > F.col("pages") * F.lit(max_ratio)).select("host", "digest"), "boilerplate")
    if common.count() <= broadcast_rows:
        met = lined(pages).join(F.broadcast(common.groupBy("host").agg(F.collect_list("digest").alias("boilerplate"))), "host", "left")
    else:
        pages, row = with_row_id(pages)
        keyed = lined(pages, F.col(row).alias("row"))
        own = keyed.select("row", "host", F.explode(digests).alias("digest"))
        found = attach(own, common.withColumn("common", F.lit(True)), ["host", "digest"], "row").where("common")
        met = keyed.join(found.groupBy("row").agg(F.collect_list("digest").alias("boilerplate")), "row", "left")
    kept = F.when(F.col("boilerplate").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("boilerplate", F.md5(x))))
    return met.withColumn("kept", kept).select(
        "page_id",
        "host",
        F.concat_ws("\n", "kept").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )


LINE_SQL = r"""
WITH p AS (
  SELECT page_id, regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host,
         list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>|<!--.*?-->', chr(10), 'g'),
           '(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|nav|article|section|header|footer|aside|main|body|html|form|blockquote|pre|dl|dt|dd|figure|figcaption|hr)\b[^>]*>', chr(10), 'g'),
           '<[/!?]?[a-zA-Z][^>]*>', '', 'g'), chr(10)), lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS lines
  FROM pages),
h AS (SELECT host, count(*) AS pages FROM p GROUP BY 1),
l AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY 1, 2),
b AS (SELECT host, list(line) AS boilerplate FROM l JOIN h USING (host) WHERE n >= 3 AND n > pages * 0.1::DOUBLE GROUP BY 1)
SELECT page_id, host, array_to_string(list_filter(lines, lambda x: NOT coalesce(list_contains(boilerplate, x), false)), chr(10)) AS text,
       len(lines)::BIGINT AS n_lines,
       (len(lines) - len(list_filter(lines, lambda x: NOT coalesce(list_contains(boilerplate, x), false))))::BIGINT AS n_dropped
FROM p LEFT JOIN b USING (host)
"""
