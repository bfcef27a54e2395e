"""Commands that work on files of results, cached descriptions and sealed holdouts."""

import base64
import json
import sys

import pytest

from sparkloom import __main__ as cli
from sparkloom.operators import gates, index
from sparkloom.plans import build


def args(*words):
    return cli.parser().parse_args(list(words))


def results(path, changes=()):
    rows = []
    for i, g in [(i, 0) for i in (*gates.PRIMARY, *gates.OFFICIAL, *gates.EXPOSED[:5])] + [("T03", 1)]:
        row = {"query_id": i, "status": "ok", "rank1_source_type": "official", "group_index": g, "identity": f"{i}/{g}", "rank": 1, "distance": 0.2, "hit": True}
        rows.append(row | dict(changes).get(i, {}))
    path.write_text("\n".join(map(json.dumps, rows)))
    return str(path)


def test_gates_tell_whether_a_release_may_go_out(spark, tmp_path):
    before = results(tmp_path / "before.jsonl")
    after = results(tmp_path / "after.jsonl", {"I02": {"hit": False, "rank": None, "distance": None, "status": "no_match"}}.items())
    for own, code in ((before, 0), (after, 1)):
        with pytest.raises(SystemExit) as end:
            cli.gate(spark, args("gate", own, "--before", before))
        assert end.value.code == code
    with pytest.raises(ValueError):
        cli.gate(spark, args("gate", before, "--kind", "fallback"))
    with pytest.raises(ValueError):
        cli.gate(spark, args("gate", before, "--kind", "other"))


CONTENT = "`fooBar my_name` is code"


def chunk(i, **more):
    base = dict.fromkeys(("upstream_repo", "upstream_commit", "source_path", "raw_url", "latest_url"), "x")
    return base | {
        "id": f"c{i}", "title": "Topic", "section_heading": f"Sec {i}", "breadcrumb": "B", "source_url": "", "page_key": "p", "category": "C", "content": CONTENT, "content_html": "", "token_estimate": 6, "chunk_index": i,
        "source_type": "companion_reference", "verification_status": "companion_unverified", "source_record_id": "r", "source_start_byte": 10 * i, "source_end_byte": 10 * i + 10, "source_token_count": 6, "content_token_count": 6,
        "embedding_token_count": 9, "s6_header": "B", "synthetic_wrapper_metadata": {"heading_line": True, "fence_open": None, "fence_close": None, "stripped_xml": False, "spans": [[0, 10]]},
    } | more


def test_descriptions_are_cached_once_and_embedded(spark, tmp_path):
    (tmp_path / "chunks.jsonl").write_text("\n".join(json.dumps(chunk(i)) for i in range(3)))
    (tmp_path / "recipe.json").write_text(json.dumps({"prompt_version": "1", "system_prompt": "s", "user_prompt_template": "{topic}: {raw_document}", "model": "m"}))
    (tmp_path / "say.py").write_text("import json, sys\njson.dump({'model': json.load(sys.stdin)['model'], 'text': 'Topic uses fooBar.'}, sys.stdout)")
    own = [str(tmp_path / x) for x in ("chunks.jsonl", "cache", "recipe.json")]
    for _ in range(2):
        cli.describe(spark, args("describe", *own, f"{sys.executable} {tmp_path / 'say.py'}"))
        assert spark.read.json(own[1]).where("status = 'ok'").count() == 3
    cli.embed(spark, args("embed", own[0], str(tmp_path / "vectors"), str(tmp_path / "manifest.json"), "--candidate=b567", "--snapshot-sha=abc", f"--cache={own[1]}", f"--recipe={own[2]}"))
    assert {r.embedding_source for r in spark.read.parquet(str(tmp_path / "vectors")).collect()} == {"description"}
    assert json.loads((tmp_path / "manifest.json").read_text())["embedding_contract"]["s7_enabled"] is True

    sealed = [{"query_id": "H1", "query": "Topic uses fooBar.", "family": "official", "targets": [{"source_record_id": "r", "anchor": {"start_byte": 12, "end_byte": 15}}]}]
    (tmp_path / "payload").write_text(base64.b64encode("\n".join(map(json.dumps, sealed)).encode()).decode())
    cli.holdout(spark, args("holdout", str(tmp_path / "payload"), str(tmp_path / "vectors"), own[0], str(tmp_path / "found")))
    (found,) = spark.read.json(str(tmp_path / "found")).collect()
    assert found.hit and found.family == "official" and "query" not in found.asDict()

    manifest = json.loads((tmp_path / "manifest.json").read_text())
    service = build.Service(spark, str(tmp_path / "vectors"), manifest, index.hash_embedder(64), model="hash", dimensions=64, candidate="b567")
    assert service.search({"q": "Topic uses fooBar."}, 2).count() == 2
    for wrong in ({"model": "other", "dimensions": 64}, {"model": "hash", "dimensions": 32}, {"model": "hash", "dimensions": 64, "candidate": "c0"}):
        with pytest.raises(ValueError):
            build.Service(spark, "", manifest, None, **wrong)
