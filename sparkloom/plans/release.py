"""Queries over whole suites of results, sealed holdouts, and files written and read back.

Suites are small and fixed: each run's results differ from the base in stated ways, and the SQL lists what a rule must say.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions import columns as C
from sparkloom.operators import evaluate, gates
from sparkloom.plans.registry import Tables, query
from sparkloom.sources import readers, sinks

MISS = {"status": "no_match", "rank": None, "distance": None, "hit": False}
FAMILIES = (gates.GENERIC_FAMILY, gates.OFFICIAL_FAMILY, *gates.OTHER_FAMILIES)


def _suite(t: Tables, changes: dict[tuple[str, int], dict], ids: tuple[str, ...] = (*gates.PRIMARY, *gates.OFFICIAL, *gates.EXPOSED[:5]), by: str = "query_id") -> DataFrame:
    """A run in which every query finds its target first, at distance 0.2; T03 has two targets. ``changes`` say where it doesn't."""
    rows = []
    for name, group in [(i, 0) for i in ids] + [("T03", 1)] * ("T03" in ids):
        base = {"status": "ok", "rank1_source_type": "official", "rank": 1, "distance": 0.2, "hit": True} | changes.get((name, group), {})
        rows.append((name, base["status"], base["rank1_source_type"], group, f"{name}/{group}", base["rank"], base["distance"], base["hit"]))
    return t.spark.createDataFrame(rows, schemas.RESULT.replace("query_id", by))


def _told(*rows: tuple[str, str, str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows) + ") v(gate, severity, message)"


@query(_told(
    ("identifier", "failure", "I03 has no target among its hits"), ("identifier", "failure", "I05 has no target among its hits"),
    ("companion", "failure", "14 of 17 distinct groups found, 15 are needed"), ("mandatory", "failure", "T03 group 1 wasn't found"), ("rescue", "failure", "G01 rank 3, at most 2"),
    ("official", "failure", "O02 rank 4, at most 3"), ("official", "failure", "E06 distance 0.5, at most 0.45"), ("official", "failure", "O04 first hit isn't official"), ("exposed", "failure", "E02 group 0 wasn't found"),
    ("identifier-regression", "failure", "I03 group 0 was found before"), ("identifier-regression", "advisory", "I05 group 0 was never found"),
))
def full_release_report(t: Tables) -> DataFrame:
    """A release with descriptions that fails a rule of each gate but the counts of generic and task queries."""
    before = _suite(t, {("I05", 0): MISS})
    after = _suite(t, {
        ("I03", 0): MISS, ("I05", 0): MISS, ("T03", 1): MISS, ("G01", 0): {"rank": 3}, ("O02", 0): {"rank": 4}, ("E06", 0): {"distance": 0.5}, ("O04", 0): {"rank1_source_type": "companion_reference"}, ("E02", 0): MISS,
    })
    return gates.full_release(after, before)


@query(_told(("generic", "failure", "3 of 5 queries pass, 4 are needed"), ("task", "failure", "3 of 5 queries pass, 4 are needed"), ("companion", "failure", "12 of 16 queries pass, 14 are needed"),
             ("companion", "failure", "13 of 17 distinct groups found, 15 are needed"), ("companion", "failure", "12 of 17 distinct groups near enough, 14 are needed")))
def full_release_counts(t: Tables) -> DataFrame:
    """Two generic and two task queries without a target, and a target that is too far."""
    lost = {(i, 0): MISS for i in ("G04", "G05", "T04", "T05")} | {("G03", 0): {"distance": 0.46}}
    return gates.full_release(_suite(t, lost), _suite(t, {}))


@query(_told(
    ("identifier", "failure", "I06 rank 3, at most 2"), ("task", "failure", "T02 distance 0.44 isn't better than 0.46"), ("regression", "failure", "T05 group 0 fell out"), ("generic", "failure", "G01 rank 2 after 1"),
    ("recall", "failure", "10 groups found, 11 before"), ("generic", "advisory", "a release without descriptions isn't held to the generic rescue gate"), ("build", "failure", "build invariants don't hold"),
))
def fallback_release_report(t: Tables) -> DataFrame:
    """A release without descriptions against its two baselines."""
    own = _suite(t, {("T02", 0): {"distance": 0.44}, ("G01", 0): {"rank": 2, "distance": 0.3}, ("T05", 0): MISS, ("I06", 0): {"rank": 3}, ("E03", 0): MISS})
    return gates.fallback_release(own, _suite(t, {("T02", 0): {"distance": 0.46}, ("G01", 0): {"distance": 0.4}}), _suite(t, {}), built=False)


@query(_told(
    ("holdout", "failure", "groovy_stream group 0 wasn't found"), ("holdout-generic", "failure", "set_document_property rank 3, at most 2"), ("holdout-generic", "advisory", "distance 0.5"), ("holdout-generic", "advisory", "distance 0.5 is over 0.45"),
    ("holdout", "failure", "groovy_stream status no_match"), ("holdout", "failure", "edi_qualifier_map status low_confidence"), ("holdout-official", "failure", "first hit isn't official"),
))
def holdout_release_report(t: Tables) -> DataFrame:
    changes = {
        ("groovy_stream", 0): MISS, (gates.GENERIC_FAMILY, 0): {"rank": 3, "distance": 0.5}, ("edi_qualifier_map", 0): {"status": "low_confidence"}, (gates.OFFICIAL_FAMILY, 0): {"rank1_source_type": "companion_reference"},
    }
    return gates.holdout_full(_suite(t, changes, FAMILIES, "family"))


@query(_told(
    ("holdout-official", "failure", "official rank 4, at most 3"), ("holdout-regression", "failure", "groovy_stream rank 2 after 1"), ("holdout-regression", "failure", "edi_qualifier_map status low_confidence after ok"),
    ("holdout-regression", "advisory", "mcp_schema_cookie had no target to be compared with"), ("holdout-generic", "advisory", "a release without descriptions isn't held to the generic rescue gate"),
))
def holdout_fallback_report(t: Tables) -> DataFrame:
    own = {(gates.OFFICIAL_FAMILY, 0): {"rank": 4}, ("groovy_stream", 0): {"rank": 2}, ("edi_qualifier_map", 0): {"status": "low_confidence"}}
    return gates.holdout_fallback(_suite(t, own, FAMILIES, "family"), _suite(t, {("mcp_schema_cookie", 0): MISS}, FAMILIES, "family"))


@query("SELECT * FROM (VALUES (false, 10::BIGINT, 1::BIGINT)) v(passed, failures, advisories)")
def release_verdict(t: Tables) -> DataFrame:
    return gates.verdict(full_release_report_frame(t))


def full_release_report_frame(t: Tables) -> DataFrame:
    from sparkloom.plans.registry import REGISTRY

    return REGISTRY["full_release_report"].run(t.spark, t.sf_dir)


@query("""SELECT conv_id::VARCHAR AS query_id, 0 AS group_index, 'text' || turn AS page, turn % 3 = 0 AND turn > 0 OR turn % 3 = 1 AS hit, CASE WHEN turn % 3 = 0 AND turn > 0 OR turn % 3 = 1 THEN 2 END AS rank FROM conversations""".replace("conv_id::VARCHAR", "conv_id || '-' || turn"))
def marked_groups(t: Tables) -> DataFrame:
    """Two hits a query, the second on the wanted page; its marker, where it has one, stands in the hit or doesn't."""
    k = F.col("turn") % 3
    name, page = F.concat_ws("-", "conv_id", "turn"), F.concat(F.lit("text"), "turn")
    base = t.conversations.select(name.alias("query_id"), page.alias("page"), k.alias("k"), "turn")
    one = base.select("query_id", F.lit(1).alias("position"), F.lit("other").alias("page_key"), F.lit("<mark>").alias("content"), F.lit(0.1).alias("distance"), F.lit("official").alias("source_type"))
    two = base.select("query_id", F.lit(2), F.concat(F.lit("https://H/"), F.upper("page"), F.lit(".html")), F.when(F.col("turn") == 0, "nothing").otherwise("a <mark> b"), F.lit(0.2), F.lit("official"))
    markers = F.when(F.col("k") == 0, F.array(F.lit("<mark>"), F.lit("absent"))).when(F.col("k") == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("absent")))
    groups = base.select("query_id", F.lit(0).alias("group_index"), F.col("page").alias("page_match"), markers.alias("markers"))
    found = evaluate.run_suite(one.union(two), groups)
    return found.select("query_id", "group_index", F.get_json_object("identity", "$.page").alias("page"), "hit", "rank")


# *** sealed holdouts

SEALED = [
    {"query_id": "H1", "query": "where?", "family": "official", "targets": [{"source_record_id": "r1", "anchor": {"start_byte": 3, "end_byte": 9}}, {"source_record_id": "r2", "anchor": {"section_heading": "Part"}}]},
    {"query_id": "H2", "query": "wie?", "family": "groovy_stream", "targets": [{"source_record_id": "r3", "anchor": {"start_byte": 0, "end_byte": 0}}]},
]
PAYLOAD = base64.b64encode("\n\n".join(json.dumps(r) for r in SEALED).encode()).decode()


@query("""SELECT * FROM (VALUES ('H1', 'where?', 'official', 0, 'r1', 3::BIGINT, 9::BIGINT, NULL, 'byte'), ('H1', 'where?', 'official', 1, 'r2', NULL, NULL, 'Part', 'section'), ('H2', 'wie?', 'groovy_stream', 0, 'r3', 0, 0, NULL, 'byte'))
v(query_id, query, family, target_index, source_record_id, start_byte, end_byte, section_heading, kind)""")
def holdout_targets(t: Tables) -> DataFrame:
    """A payload's targets, byte ranges and headings."""
    return readers.holdout(t.spark, PAYLOAD).withColumn("kind", C.anchor_kind(F.col("start_byte"), F.col("end_byte"), F.col("section_heading")))


@query(f"SELECT sha256('{PAYLOAD}') AS sha256, 2 AS n")
def holdout_commitment(t: Tables) -> DataFrame:
    told = readers.holdout_commitment(PAYLOAD)
    return t.spark.createDataFrame([(told["sha256"], told["count"])], "sha256 string, n int")


# *** files written and read back


@query("SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def json_lines(t: Tables) -> DataFrame:
    """Documents as ordered JSON lines and back, nulls and line ends included."""
    path = t.scratch("lines")
    sinks.jsonl(t.documents.select("doc_id", "text", "lang"), path, "doc_id")
    return readers.jsonl(t.spark, path, "doc_id long, text string, lang string").select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("SELECT 'page_' || page_id || '.html' AS file, strlen(html)::BIGINT AS bytes, md5(html) AS html_md5 FROM pages")
def html_files(t: Tables) -> DataFrame:
    """Pages written as files by the executors, and the folder read back."""
    path = t.scratch("html")
    pages = t.pages.select(F.concat(F.lit("page_"), "page_id", F.lit(".html")).alias("filename"), "html")
    written = sinks.html_documents(pages, path).agg(F.sum("bytes")).first()[0]
    back = readers.html_files(t.spark, path).select("file", F.octet_length("html").cast("long").alias("bytes"), F.md5("html").alias("html_md5"))
    return back.where(F.lit(written).isNotNull())


@query("""SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 = 1 THEN 'b' ELSE 'a' END AS text, n_regionkey::INT AS region FROM nation""")
def text_trees(t: Tables) -> DataFrame:
    """Files in folders, as paths relative to the root, hashed by their bytes."""
    path = t.scratch("tree")
    files = t.nation.select(F.format_string("r%d-n%d.html", "n_regionkey", "n_nationkey").alias("filename"), F.when(F.col("n_nationkey") % 4 == 1, "b").otherwise("a").alias("html"))
    sinks.html_documents(files, path).collect()
    found = readers.text_files(t.spark, path).where(F.sha2("text", 256) == F.col("sha256")).where("bytes = 1")
    return found.select(F.regexp_extract("path", r"n(\d+)\.html$", 1).cast("int").alias("k"), "text", F.regexp_extract("path", r"^r(\d+)", 1).cast("int").alias("region"))


@query("SELECT url, depth, root_index FROM (SELECT 'https://h/r' || r_regionkey AS url, 1 AS depth, r_regionkey::INT AS root_index FROM region UNION ALL SELECT 'https://h/n' || n_nationkey, 2, n_regionkey::INT FROM nation)")
def saved_trees(t: Tables) -> DataFrame:
    """A URL configuration saved over an older one, which is kept, and read again."""
    import os

    from sparkloom.operators import tree

    path = t.scratch("config") + "/urls.json"
    names = {r.r_regionkey: [] for r in t.region.select("r_regionkey").collect()}
    for r in t.nation.select("n_regionkey", "n_nationkey").orderBy("n_nationkey").collect():
        names[r.n_regionkey].append({"url": f"https://h/n{r.n_nationkey}", "children": []})
    sinks.save_json({"urls": []}, path)
    sinks.save_tree([{"url": f"https://h/r{k}", "children": v} for k, v in sorted(names.items())], path)
    if not os.path.exists(path + ".bak"):
        raise RuntimeError("the former configuration is gone")
    return tree.nodes(t.spark, readers.load_tree(path)).select("url", "depth", "root_index")
