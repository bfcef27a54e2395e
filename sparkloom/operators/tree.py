"""URL trees as node tables: flattening, depths, subtree sizes, balanced shards, deltas, crawling and rendering."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import Any
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions import columns as C
from sparkloom.functions import html
from sparkloom.operators.rows import flat_map
from sparkloom.session import written


def flatten(roots: list[dict[str, Any]]) -> Iterator[dict[str, Any]]:
    """Nodes of a configuration's tree in document order, with depth from 1 and a sortable path."""
    pending: list[tuple[dict[str, Any], int | None, int, int, str]] = [(r, None, i, 1, f"{i:06d}") for i, r in reversed(list(enumerate(roots)))]
    n = 0
    while pending:
        node, parent, root, depth, path = pending.pop()
        yield {"node_id": n, "url": node["url"], "parent_id": parent, "root_index": root, "depth": depth, "path": path}
        children = list(enumerate(node.get("children") or []))
        pending.extend((c, n, root, depth + 1, f"{path}/{k:06d}") for k, c in reversed(children))
        n += 1


def nodes(spark: SparkSession, roots: list[dict[str, Any]]) -> DataFrame:
    return spark.createDataFrame([tuple(r.values()) for r in flatten(roots)], schemas.URL_NODE)


def nest(rows: list[Any]) -> list[dict[str, Any]]:
    """The tree of node rows, for a configuration file."""
    made = {r["node_id"]: {"url": r["url"], "children": []} for r in rows}
    roots = []
    for r in sorted(rows, key=lambda r: r["path"]):
        (made[r["parent_id"]]["children"] if r["parent_id"] is not None else roots).append(made[r["node_id"]])
    return roots


def parse_root_indices(raw: str | None, total: int) -> list[int] | None:
    """Ascending distinct numbers of a comma-separated list; None for all."""
    if not raw:
        return None
    out = set()
    for part in filter(None, map(str.strip, raw.split(","))):
        if not part.lstrip("+-").isdigit():
            raise ValueError(f"not a root number: {part}")
        if not 0 <= int(part) < total:
            raise ValueError(f"root {part} is not in 0..{total - 1}")
        out.add(int(part))
    return sorted(out)


def select_roots(tree: DataFrame, indices: list[int] | None) -> DataFrame:
    return tree if indices is None else tree.where(F.col("root_index").isin(*indices))


def closure(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, ancestor, distance) of all pairs on a path, itself at distance 0. Each round doubles the reach, and is written down.

    ValueError if the edges run in a circle, which no tree's do.
    """
    reach = written(edges.select(F.col(node).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("distance")).where("ancestor IS NOT NULL"), "reach")
    span = 1
    while True:
        # all of distance 1 to span are there: those of span + 1 to 2 span are one of exactly span, then any
        far = reach.where(F.col("distance") == span).alias("a").join(reach.alias("b"), F.col("a.ancestor") == F.col("b.node"))
        far = written(far.select("a.node", "b.ancestor", (F.col("a.distance") + F.col("b.distance")).alias("distance")), "far")
        if far.isEmpty():
            break
        if not far.where("node = ancestor").isEmpty():
            raise ValueError("the edges run in a circle")
        reach = reach.unionByName(far)
        span *= 2
    own = edges.select(F.col(node).alias("node"), F.col(node).alias("ancestor"), F.lit(0).alias("distance"))
    return reach.unionByName(own)


def depths_and_sizes(tree: DataFrame) -> DataFrame:
    """url, depth and size of the subtree of each node, from sortable paths: a node's descendants share its prefix."""
    prefixes = F.transform(F.sequence(F.lit(1), F.size(F.split("path", "/"))), lambda k: F.array_join(F.slice(F.split("path", "/"), 1, k), "/"))
    sizes = tree.select(F.explode(prefixes).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("size"))
    return tree.join(sizes, "path").select("node_id", "url", "root_index", "depth", "size")


def tree_stats(tree: DataFrame) -> DataFrame:
    return tree.agg(F.count(F.lit(1)).alias("urls"), F.count_if(F.col("depth") == 1).alias("roots"), F.max("depth").alias("deepest"), F.avg("depth").alias("mean_depth"))


def balance(sizes: list[tuple[int, int]], shards: int) -> list[dict[str, Any]]:
    """Largest first onto the least loaded shard; ties go to the lower shard. One row a shard."""
    count = max(1, min(shards, len(sizes)))
    heap: list[tuple[int, int]] = [(0, s) for s in range(count)]
    held: dict[int, list[int]] = {s: [] for s in range(count)}
    for index, size in sorted(sizes, key=lambda x: -x[1]):
        load, shard = heap[0]
        held[shard].append(index)
        heapq.heapreplace(heap, (load + size, shard))
    loads = {s: load for load, s in heap}
    return [{"shard": s, "root_indices": ",".join(map(str, sorted(held[s]))), "root_count": len(held[s]), "url_count": loads[s]} for s in range(count)]


def shard_matrix(tree: DataFrame, shards: int = 4) -> DataFrame:
    """Balanced shards of a tree's roots; greedy by nature, over one row a root."""
    sizes = [(r["root_index"], r["n"]) for r in tree.groupBy("root_index").agg(F.count(F.lit(1)).alias("n")).orderBy("root_index").collect()]
    return tree.sparkSession.createDataFrame([tuple(r.values()) for r in balance(sizes, shards)], "shard int, root_indices string, root_count int, url_count long")


def delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """(url, change): added, removed or unchanged."""
    a, b = old.select("url").distinct().withColumn("was", F.lit(True)), new.select("url").distinct().withColumn("now", F.lit(True))
    return a.join(b, "url", "full_outer").select("url", F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("unchanged").alias("change"))


def sample_urls(tree: DataFrame, n: int = 20, seed: int = 7) -> DataFrame:
    """Up to ``n`` distinct nodes at random, the same for the same seed."""
    return tree.orderBy(F.md5(F.concat(F.lit(str(seed)), "url")), "node_id").limit(n)


def unreachable(tree: DataFrame, get: Callable[[str], tuple[int, str, str]], n: int = 20, delay: float = 1.0, wait: Callable[[float], None] | None = None) -> DataFrame:
    """(url, status) of a sample's nodes that don't answer with 200; status 0 is no answer at all."""
    from sparkloom.sources.readers import http_pages

    return http_pages(sample_urls(tree, n).select("url"), get, tries=1, delay=delay, wait=wait).where("status <> 200").select("url", "status")


def sidebar_items(pages: DataFrame, hosts: frozenset[str] = frozenset()) -> DataFrame:
    """Menu items of each page (url, html)."""
    return flat_map(pages.select("url", "html"), lambda row: ({"url": row["url"], **x} for x in html.sidebar(html.parse(row["html"] or ""), hosts)), f"url string, {schemas.SIDEBAR_ITEM}")


def crawl(name: str, root_url: str, fetch: Callable[[str], str | None], seen: set[str], hosts: frozenset[str] = frozenset()) -> list[dict[str, Any]]:
    """A section's tree by its menus: categories are entered depth first, pages met before are left out.

    ``fetch`` gives a page's HTML or None. The order decides what a page met twice belongs to, so this is a driver's
    loop; pages are fetched one at a time, as a polite crawler does.
    """
    base = "{0.scheme}://{0.netloc}".format(urlparse(root_url))
    page = fetch(root_url)
    if not page:
        return []

    def enter(url: str) -> dict[str, Any] | None:
        if url in seen:
            return None
        seen.add(url)
        found = fetch(url)
        items = html.current_children(html.sidebar(html.parse(found), hosts)) if found else []
        return {"url": url, "children": [n for item in items if (n := visit(item, True))]}

    def visit(item: dict[str, Any], once: bool) -> dict[str, Any] | None:
        url = html.absolute_link(item["href"], base)
        if item["is_category"]:
            return enter(url)
        if once and url in seen:
            return None
        seen.add(url)
        return {"url": url, "children": []}

    top = [x for x in html.sidebar(html.parse(page), hosts) if x["level"] == 2]
    return [n for item in top if (n := visit(item, False))]


def clean_article(page: str, url: str, element: str = "div", classes: str | None = "theme-doc-markdown markdown") -> tuple[str, str]:
    """(title, body): the article with absolute links, without classes, ids, drawings and its first main heading."""
    root = html.parse(page)
    found = html.container(root, element, classes)
    body = html.Element("#root")
    if found:
        body.add(found)
    html.absolute_urls(body, "{0.scheme}://{0.netloc}".format(urlparse(url)))
    html.drop_styling(body)
    heading = body.first("h1")
    title = heading.text() if heading else url
    if heading:
        heading.remove()
    return title, body.render()


def render_roots(tree: DataFrame, pages: DataFrame, element: str = "div", classes: str | None = "theme-doc-markdown markdown") -> DataFrame:
    """(root_index, filename, html): one document a root, each page under a heading of its depth and its path.

    ``pages`` has url and html; a page that wasn't fetched is a heading only, its URL for a title. Titles along a
    node's path come by joining its prefixes, then a root's parts are concatenated in path order.
    """
    parts = flat_map(
        tree.join(pages.select("url", "html"), "url", "left").select("root_index", "depth", "path", "url", "html"),
        lambda r: [{k: r[k] for k in ("root_index", "depth", "path", "url")} | dict(zip(("title", "body"), clean_article(r["html"] or "", r["url"], element, classes)))],
        "root_index int, depth int, path string, url string, title string, body string",
    )
    prefixes = F.transform(F.sequence(F.lit(1), F.size(F.split("path", "/"))), lambda k: F.array_join(F.slice(F.split("path", "/"), 1, k), "/"))
    crumb = F.concat(F.lit("<a href='"), "up.url", F.lit("'>"), "up.title", F.lit("</a>"))
    crumbs = (
        parts.select(F.col("path").alias("own"), F.explode(prefixes).alias("prefix")).join(parts.alias("up"), F.col("prefix") == F.col("up.path"))
        .groupBy("own").agg(F.array_sort(F.collect_list(F.struct("prefix", crumb.alias("crumb")))).alias("c"))
        .select("own", F.array_join(F.transform("c", lambda x: x["crumb"]), " > ").alias("crumbs"))
    )
    level = F.concat(F.lit("h"), (F.col("depth")).cast("string"))
    text = F.concat(F.lit("<"), level, F.lit(">"), "title", F.lit("</"), level, F.lit(">\n\n<p><strong>Path:</strong> "), "crumbs", F.lit("</p>\n\n"), "body", F.lit("\n\n"))
    whole = parts.join(crumbs, F.col("path") == F.col("own")).select("root_index", "path", "title", "url", text.alias("text"))
    first = F.min_by(F.struct("title", "url"), "path")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "text"))), lambda x: x["text"]), "")
    return whole.groupBy("root_index").agg(first.alias("r"), joined.alias("html")).select("root_index", C.output_filename(F.col("r.title"), F.col("r.url")).alias("filename"), "html")


