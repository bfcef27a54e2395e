"""Files, snapshots, archives, trees, whole jobs and streams."""

import base64
import hashlib
import io
import json
import tarfile

import pytest

from sparkloom.functions.header import COMPANION
from sparkloom.operators import index, tree, validate
from sparkloom.plans import build
from sparkloom.sources import readers, sinks
from sparkloom.streaming import ingest

COMMIT = "0123456789" * 4
TEXTS = {"docs/one.md": "# One\n\nWords of it.\n\n## Part\n\n```\nfooBar a_b\n```\n", "docs/two.md": "# Two\n\n" + "More words here. " * 300}
CONFIG = {
    **{f"{kind}_url_template": f"https://{kind}/{{commit}}/{{path}}" for kind in ("raw", "blob")}, "latest_blob_url_template": "https://blob/main/{path}", "repo": "o/r", "commit": COMMIT,
    "files": [{"path": "docs/two.md", "title": "Second", "area": "B", "sections": ["x", "two"]}, {"path": "docs/one.md", "area": "A", "drop_sections": ["zzz"], "priority": 2}],
}


@pytest.fixture
def corpus(spark, tmp_path):
    """Official pages, staged files, manifest and configuration."""
    (tmp_path / "official").mkdir()
    (tmp_path / "official/a.html").write_text("<h1>A</h1><p>text of a</p><h2>B</h2><p>" + "words and words. " * 200 + "</p>")
    (tmp_path / "official/note.txt").write_text("not a page")
    for path, text in TEXTS.items():
        (tmp_path / "staging" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "staging" / path).write_text(text)
    sinks.save_json(CONFIG, str(tmp_path / "config.json"))
    files = readers.source_files(spark, CONFIG).join(spark.createDataFrame(list(TEXTS.items()), "path string, text string"), "path")
    sinks.save_json(sinks.fetch_manifest(CONFIG, files, "now"), str(tmp_path / "manifest.json"))
    return tmp_path


def paths(corpus):
    return {"official": f"{corpus}/official", "staging": f"{corpus}/staging", "manifest": f"{corpus}/manifest.json", "config": f"{corpus}/config.json"}


def test_manifest_and_verification(spark, corpus):
    manifest = json.loads((corpus / "manifest.json").read_text())
    assert [x["path"] for x in manifest["files"]] == ["docs/two.md", "docs/one.md"] and manifest["files"][0]["raw_url"] == f"https://raw/{COMMIT}/docs/two.md"
    found = readers.verified_files(spark, str(corpus / "manifest.json"), str(corpus / "staging"), str(corpus / "config.json"))
    assert {r.path: r.text for r in found.collect()} == TEXTS
    (corpus / "staging/docs/one.md").write_text("changed")
    with pytest.raises(ValueError, match="content differs"):
        readers.verified_files(spark, str(corpus / "manifest.json"), str(corpus / "staging"))
    (corpus / "staging/docs/one.md").unlink()
    with pytest.raises(ValueError, match="missing"):
        readers.verified_files(spark, str(corpus / "manifest.json"), str(corpus / "staging"))


def test_drift(spark):
    manifest = json.loads(json.dumps(CONFIG))
    assert readers.curation_drift(spark, CONFIG, manifest).collect() == []
    manifest["files"][0]["sections"] = ["two", "x", "x"]
    assert readers.curation_drift(spark, CONFIG, manifest).collect() == []
    manifest["commit"] = "f" * 40
    manifest["files"][0]["title"] = "Old"
    manifest["files"][1]["path"] = "docs/three.md"
    found = {(r.path, r.field) for r in readers.curation_drift(spark, CONFIG, manifest).collect()}
    assert found == {(None, "commit"), ("docs/two.md", "title"), ("docs/one.md", "file"), ("docs/three.md", "file")}


@pytest.mark.parametrize("change", [{"commit": "main"}, {"commit": "A" * 40}, {"files": []}, {"files": [{"path": "../x"}]}, {"files": [{"path": "a.sh"}]}, {"files": [{"path": "a"}, {"path": "a"}]}, {"files": [{}]}, {"raw_url_template": "x/{path}"}, {"blob_url_template": "{commit}{path}"}, {"latest_blob_url_template": "x"}])
def test_bad_configurations(change):
    readers.check_config(CONFIG)
    with pytest.raises(ValueError):
        readers.check_config(CONFIG | change)
    with pytest.raises(ValueError):
        readers.check_config([])


def test_path_rules_agree_with_columns(spark):
    from sparkloom.functions import columns as C

    cases = ["a/b.md", "", "/a", "a\\b", "./a", "a//b", "a/../b", "x/README.md", "run.SH", "a/."]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    assert [r[0] for r in df.select(C.is_denied_path(df.p)).collect()] == [readers.denied(c) for c in cases] == [False] + [True] * 9


def test_snapshot(spark, corpus):
    out = str(corpus / "snapshot")
    document = sinks.freeze(spark, out=out, **paths(corpus))
    assert [f["path"] for f in document["files"]] == ["companion/docs/one.md", "companion/docs/two.md", "companion_manifest.json", "companion_sources.json", "official/a.html", "official/note.txt"]
    lines = "\n".join(f"{f['path']}\t{f['sha256']}" for f in document["files"])
    assert document["source_snapshot_sha256"] == hashlib.sha256(lines.encode()).hexdigest() == sinks.verify_snapshot(spark, out)
    assert sinks.freeze(spark, out=out, **paths(corpus))["source_snapshot_sha256"] == document["source_snapshot_sha256"]
    with pytest.raises(ValueError, match="can't be given"):
        sinks.snapshot_inputs(spark, out, official="x")
    (corpus / "snapshot/extra").write_text("x")
    with pytest.raises(ValueError, match="unrecorded"):
        sinks.verify_snapshot(spark, out)
    (corpus / "snapshot/extra").unlink()
    (corpus / "snapshot/official/a.html").write_text("x")
    with pytest.raises(ValueError, match="a.html, drifted"):
        sinks.verify_snapshot(spark, out)


def test_whole_build_and_search(spark, corpus):
    out = str(corpus / "snapshot")
    sha = sinks.freeze(spark, out=out, **paths(corpus))["source_snapshot_sha256"]
    chunks = build.build_chunks(spark, snapshot=out).cache()
    assert {r.source_type for r in chunks.select("source_type").distinct().collect()} == {"official", COMPANION}
    embed = index.hash_embedder(16)
    document = build.build_index(chunks, str(corpus / "vectors"), candidate="b56", embedder=embed, model="hash", dimensions=16, snapshot_sha=sha)
    assert document["chunk_count"] == chunks.count() and document["schema_version"] == "2"
    again = build.build_index(chunks, str(corpus / "vectors"), candidate="b56", embedder=embed, model="hash", dimensions=16, snapshot_sha=sha)
    assert again["semantic_inputs_sha256"] == document["semantic_inputs_sha256"]
    hits = build.search(spark, str(corpus / "vectors"), {"q": "fooBar a_b part one"}, embed, 3).orderBy("position").collect()
    assert len(hits) == 3 and "fooBar" in hits[0].content
    official = build.search(spark, str(corpus / "vectors"), {"q": "fooBar"}, embed, 3, "official").collect()
    assert official and all(h.source_type == "official" for h in official)
    with pytest.raises(ValueError, match="lineage"):
        build.build_index(chunks, "x", candidate="c0", embedder=embed, model="m", dimensions=16)
    legacy = build.build_chunks(spark, exact=False, **paths(corpus))
    assert validate.chunk_errors(legacy).collect() == []
    sinks.jsonl(chunks, str(corpus / "jsonl"), "corpus_ord", "file", "ord")
    assert readers.chunks(spark, str(corpus / "jsonl")).count() == chunks.count()


def archive(folder, shard, files):
    with tarfile.open(folder / f"knowledge-base-shard-{shard}.tar.gz", "w:gz") as tar:
        for name, text in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))


def test_archives(spark, tmp_path):
    archive(tmp_path, 10, {"knowledge_base/shard-10/a.html": "same", "knowledge_base/shard-10/b.html": "b", "failed_urls_shard_10.txt": "u2\nu1\n\n"})
    archive(tmp_path, 2, {"knowledge_base/shard-2/a.html": "same", "failed_urls_shard_2.txt": "u1\n"})
    rows = readers.archives(spark, str(tmp_path))
    files, failed = sinks.assemble(rows)
    assert {r.path: r.text for r in files.collect()} == {"a.html": "same", "b.html": "b"}
    assert sinks.url_report(failed, str(tmp_path / "failed.txt"), "order") == 2 and (tmp_path / "failed.txt").read_text() == "u1\nu2"
    report = sinks.scrape_report(rows, 11)
    assert "Shards missing: 0, 1, 3, 4, 5, 6, 7, 8, 9" in report and "- 10: 2 pages, 2 failed URLs" in report and "In all: 2" in report
    archive(tmp_path, 3, {"knowledge_base/shard-3/a.html": "different"})
    with pytest.raises(Exception, match="disagree"):
        sinks.merge_files(sinks.assemble(readers.archives(spark, str(tmp_path)))[0]).collect()


def test_fetching(spark):
    answers = {"ok": (200, "text/plain", "# T"), "gone": (404, "", ""), "html": (200, "text/HTML", "x"), "page": (200, "", " <!DOCTYPE html>"), "blank": (200, "", " \n"), "down": (503, "", "")}
    urls = spark.createDataFrame([(u,) for u in answers], "url string")
    fetched = readers.http_pages(urls, lambda u: answers[u], wait=lambda s: None)
    assert {r.url for r in readers.failed_urls(fetched).collect()} == {"gone", "down"}
    assert {r.url: r.error for r in readers.reject_non_markdown(fetched).collect()} == {"gone": "status 404", "down": "status 503", "html": "HTML instead of Markdown", "page": "HTML instead of Markdown", "blank": "empty body"}


ROOTS = [{"url": "http://h/r0", "children": [{"url": "http://h/a", "children": [{"url": "http://h/b"}]}, {"url": "http://h/c"}]}, {"url": "http://h/r1"}, {"url": "http://h/r2", "children": [{"url": "http://h/d"}]}]


def test_trees(spark, tmp_path):
    nodes = tree.nodes(spark, ROOTS).cache()
    assert [(r.url[-2:], r.depth, r.size) for r in tree.depths_and_sizes(nodes).orderBy("node_id").collect()] == [("r0", 1, 4), ("/a", 2, 2), ("/b", 3, 1), ("/c", 2, 1), ("r1", 1, 1), ("r2", 1, 2), ("/d", 2, 1)]
    assert tree.nest(nodes.collect())[0]["children"][0]["children"] == [{"url": "http://h/b", "children": []}]
    assert [tuple(r) for r in tree.shard_matrix(nodes, 2).orderBy("shard").collect()] == [(0, "0", 1, 4), (1, "1,2", 2, 3)]
    assert len(tree.balance([(0, 1)], 9)) == 1
    assert tree.parse_root_indices("2, 0,2,", 3) == [0, 2] and tree.parse_root_indices("", 3) is None
    for bad in ("x", "3", "-1"):
        with pytest.raises(ValueError):
            tree.parse_root_indices(bad, 3)
    assert tree.select_roots(nodes, [1]).count() == 1 and tree.tree_stats(nodes).first().deepest == 3
    assert tree.sample_urls(nodes, 3).collect() == tree.sample_urls(nodes, 3).collect()
    sinks.save_tree(ROOTS, str(tmp_path / "c.json"))
    sinks.save_tree([], str(tmp_path / "c.json"))
    assert readers.load_tree(str(tmp_path / "c.json.bak")) == ROOTS
    sinks.matrix_outputs(tree.shard_matrix(nodes, 2), str(tmp_path / "out"))
    assert (tmp_path / "out").read_text().endswith("shard_count=2\n")


def test_rendered_roots(spark, tmp_path):
    pages = spark.createDataFrame([(u, f'<div class="theme-doc-markdown markdown"><h1>T {u[-2:]}</h1><p class="x"><a href="/z">l</a></p></div>') for u in ("http://h/r0", "http://h/a", "http://h/r1")], "url string, html string")
    found = {r.root_index: r for r in tree.render_roots(tree.nodes(spark, ROOTS), pages).collect()}
    assert found[0].filename == hashlib.sha1(b"http://h/r0").hexdigest()[:10] + "_T_r0.html"
    assert found[0].html.index("<h1>T r0</h1>") < found[0].html.index("<h2>T /a</h2>") < found[0].html.index("<h3>http://h/b</h3>") < found[0].html.index("<h2>http://h/c</h2>")
    assert "<a href='http://h/r0'>T r0</a> > <a href='http://h/a'>T /a</a></p>" in found[0].html and '<p><a href="http://h/z">l</a></p>' in found[0].html
    written = sinks.html_documents(spark.createDataFrame([(r.filename, r.html) for r in found.values()], "filename string, html string"), str(tmp_path / "pages")).collect()
    assert len(written) == 3 and len(list((tmp_path / "pages").glob("*.html"))) == 3


def test_crawl():
    def nav(current, *items):
        rows = "".join(f'<li class="level-{n}"><a class="menu__link{" menu__link--sublist" if cat else ""}" href="{h}"{" aria-current=\"page\"" if h == current else ""}>{h}</a></li>' for n, h, cat in items)
        return f'<nav class="menu">{rows}</nav>'

    site = {
        "http://h/": nav("", (2, "/a", True), (2, "/x", False)),
        "http://h/a": nav("/a", (2, "/a", True), (3, "/b", True), (3, "/c", False), (2, "/x", False)),
        "http://h/b": nav("/b", (3, "/b", True), (4, "/c", False), (4, "/a", True)),
    }
    found = tree.crawl("s", "http://h/", site.get, set())
    assert found == [{"url": "http://h/a", "children": [{"url": "http://h/b", "children": [{"url": "http://h/c", "children": []}]}]}, {"url": "http://h/x", "children": []}]
    assert tree.crawl("s", "http://gone/", site.get, set()) == []


def test_holdout_payload(spark):
    good = {"query_id": "q", "query": "text", "family": "f", "targets": [{"source_record_id": "r", "anchor": {"start_byte": 1, "end_byte": 4}}, {"source_record_id": "r", "anchor": {"section_heading": "H"}}]}
    pack = lambda *rows: base64.b64encode("\n\n".join(json.dumps(r) for r in rows).encode()).decode()
    found = readers.holdout(spark, pack(good)).collect()
    assert [(r.target_index, r.start_byte, r.section_heading) for r in found] == [(0, 1, None), (1, None, "H")]
    assert readers.holdout_commitment(pack(good, good)) == {"sha256": hashlib.sha256(pack(good, good).encode()).hexdigest(), "count": 2}
    bad = [good | {"targets": []}, {k: v for k, v in good.items() if k != "family"}, good | {"targets": [{"source_record_id": "", "anchor": {"section_heading": "H"}}]}]
    bad += [good | {"targets": [{"source_record_id": "r", "anchor": a}]} for a in ({}, {"start_byte": 5, "end_byte": 4}, {"start_byte": True, "end_byte": 4}, {"section_heading": " "}, None)]
    for row in bad:
        with pytest.raises(ValueError):
            readers.holdout(spark, pack(row))
    for raw in ("!!!", base64.b64encode(b"\xff").decode(), base64.b64encode(b"{").decode()):
        with pytest.raises(ValueError):
            readers.holdout(spark, raw)


def test_stream_of_files(spark, tmp_path):
    for day, rows in enumerate([[("a", "2024-01-01 00:10:00", 1.0), ("b", "2024-01-01 00:50:00", 2.0)], [("a", "2024-01-01 00:10:00", 1.0), ("c", "2024-01-01 01:10:00", 4.0)]]):
        spark.createDataFrame(rows, "id string, t string, v double").selectExpr("id", "timestamp(t) AS ts", "v").coalesce(1).write.parquet(f"{tmp_path}/in/{day}")
    stream = ingest.read(spark, f"{tmp_path}/in/*", "id string, ts timestamp, v double", files_at_once=1)
    ingest.run_once(ingest.first_arrivals(stream, ["id"], "ts"), "arrived", f"{tmp_path}/c1", "append")
    assert sorted(r.id for r in spark.table("arrived").collect()) == ["a", "b", "c"]


def test_command_line(spark, corpus, monkeypatch):
    from sparkloom import __main__ as cli

    monkeypatch.setattr(cli, "session", lambda name: spark)
    where = [f"--{k}={v}" for k, v in paths(corpus).items()]
    cli.main(["snapshot", f"{corpus}/snap", *where])
    cli.main(["chunk", f"{corpus}/chunks", f"--snapshot={corpus}/snap"])
    sha = json.loads((corpus / "snap/snapshot_manifest.json").read_text())["source_snapshot_sha256"]
    cli.main(["embed", f"{corpus}/chunks", f"{corpus}/table", f"{corpus}/index.json", "--dimensions=16", f"--snapshot-sha={sha}"])
    assert json.loads((corpus / "index.json").read_text())["chunk_count"] > 3
    sinks.save_json([{"query_id": "q", "query": "fooBar a_b", "groups": [{"page_match": "one.md", "markers": ["fooBar"]}, {"page_match": "zzz"}]}], f"{corpus}/fixtures.json")
    cli.main(["evaluate", f"{corpus}/fixtures.json", f"{corpus}/table", f"{corpus}/results", "--dimensions=16"])
    found = {r.group_index: r.hit for r in spark.read.json(f"{corpus}/results").collect()}
    assert found == {0: True, 1: False}
    sinks.save_json({"urls": ROOTS}, f"{corpus}/tree.json")
    cli.main(["shards", f"{corpus}/tree.json", "--shards=2", f"--outputs={corpus}/gh"])
    assert (corpus / "gh").read_text().startswith('matrix={"include":[{"shard":0,')


def test_bundles(spark, tmp_path):
    for name, distance in (("a", 0.2), ("b", 0.2), ("c", 0.3)):
        (tmp_path / name).mkdir()
        group = {"index": 0, "identity": ["p", []], "rank": 1, "distance": distance, "hit": True}
        sinks.save_json({"queries": {"q": {"status": "ok", "groups": [group]}}}, f"{tmp_path}/{name}/results.json")
        sinks.save_json({"embedding_contract": {"v": 1 if name != "c" else 2}}, f"{tmp_path}/{name}/manifest.json")
        lines = [{"id": "i", "raw_document": "d", "canonical_metadata": {"x": name == "c"}, "embedding_input_sha256": "s"}, {"semantic_inputs_sha256": "h"}]
        (tmp_path / name / "semantic_inputs.jsonl").write_text("\n".join(map(json.dumps, lines)))
    a, b, c = (readers.run_bundle(spark, f"{tmp_path}/{n}") for n in "abc")
    assert build.compare_bundles(a, b).collect() == []
    assert {(r.item, r.failure) for r in build.compare_bundles(a, c).collect()} == {("run", "contracts"), ("i", "canonical_metadata"), ("q/0", "distances")}


def test_digest_streams_in_order(spark):
    from sparkloom.operators.rows import digest_in_order

    values = [f"{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in reversed(values)], "v string").repartition(7)
    for chunk in (10, 1 << 20):
        assert digest_in_order(df, "v", "v", between=",", before="[", after="]", chunk=chunk) == hashlib.sha256(f"[{','.join(values)}]".encode()).hexdigest()
    assert digest_in_order(df.limit(0), "v", "v") == hashlib.sha256(b"").hexdigest()
