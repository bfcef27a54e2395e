"""Cache, embedding plans, search, evaluation and gates."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions import columns as C
from sparkloom.functions.tokenizer import QuarterTokenizer
from sparkloom.operators import cache, evaluate, gates, index

T = QuarterTokenizer()
RECIPE = cache.contract(prompt_version="1", system_prompt="s", user_prompt_template="{topic}: {raw_document} {section_heading} {breadcrumb}", model="m")
CODE = "```\n<n:Map type='K'/> fooBar\n```"
CHUNK = "id string, content string, title string, section_heading string, breadcrumb string, source_type string, source_record_id string, source_start_byte long, source_end_byte long, s6_header string"


@pytest.fixture(scope="module")
def chunks(spark):
    companion = "companion_reference"
    data = [("b", CODE, "Map", "h", "x", companion, "r", 5, 9, "H"), ("a", CODE, "Map", "h", "x", companion, "r", 0, 4, "H"), ("c", CODE + " more", "Map", "h", "x", companion, "r", 9, 12, ""), ("o", CODE, "Map", "h", "x", "official", "q", 0, 1, "H"), ("p", "prose", "Map", "h", "x", companion, "r", 12, 17, "H")]
    return spark.createDataFrame(data, CHUNK)


def test_keys_and_usages(chunks):
    keyed = cache.keyed(cache.eligible(chunks, T), RECIPE)
    found = {r.cache_key: [tuple(u) for u in r.usages] for r in cache.usages(keyed).collect()}
    assert sorted(map(len, found.values())) == [1, 2] and [("a", "r", 0, 4), ("b", "r", 5, 9)] in found.values()
    row = keyed.where("id = 'a'").first()
    text = cache.canonical_json({"raw_document": CODE, "title": "Map", "section_heading": "h", "breadcrumb": "x", "source_type": "companion_reference", "identifiers": sorted(row.identifiers)})
    import hashlib

    sha = hashlib.sha256(text.encode()).hexdigest()
    assert row.generation_input_sha256 == sha and row.cache_key == hashlib.sha256(f"{sha}\x00{cache.contract_sha(RECIPE)}".encode()).hexdigest()


def test_generation_and_release(chunks, spark):
    keyed = cache.keyed(cache.eligible(chunks, T), RECIPE)
    nothing = spark.createDataFrame([], schemas.CACHE_RECORD)
    lost = cache.missing(keyed, nothing)
    assert sorted(r.chunk.id for r in lost.collect()) == ["a", "c"]

    def call(system, user, model):
        return ("m", "The Map is an n:Map of K.") if "more" not in user else ("other", "x")

    made = cache.generate(lost, RECIPE, call, T)
    assert {(r.status, r.description) for r in made.collect()} == {("ok", "The Map is an n:Map of K."), ("raw_fallback", "")}
    assert cache.missing(keyed, made).collect() == [] and cache.append_errors(nothing, made).collect() == []
    assert {r.error for r in cache.append_errors(made, made).collect()} == {"key exists"}
    assert [r.error for r in cache.release_errors(keyed, made).collect()] == ["fallback 1 of 3"]
    assert len([r for r in cache.release_errors(keyed, nothing).collect() if r.error.startswith("missing")]) == 2
    changed = made.withColumn("description", F.concat("description", F.lit("!")))
    assert {r.error for r in cache.immutability_errors(made, changed).collect()} == {"modified"} and cache.immutability_errors(made, made).collect() == []
    assert {r.error for r in cache.immutability_errors(made, made.where("status = 'ok'")).collect()} == {"removed"}
    plan = {r.id: (r.embedding_source, r.embedding_input) for r in index.embedding_plan(keyed.unionByName(cache.keyed(chunks.where("id IN ('o', 'p')"), RECIPE)), "b567", cache=made, eligible_ids=keyed.select("id")).collect()}
    assert plan["a"] == ("description", "The Map is an n:Map of K.") and plan["c"] == ("raw_fallback", CODE + " more") and plan["o"] == ("raw", f"H\n{CODE}") and plan["p"] == ("raw", "H\nprose")
    with pytest.raises(Exception, match="no cached description"):
        index.embedding_plan(keyed, "b567", cache=nothing, eligible_ids=keyed.select("id")).collect()


@pytest.mark.parametrize(("fallbacks", "passes"), [(2, True), (3, False)])
def test_fallback_share(spark, fallbacks, passes):
    used = spark.createDataFrame([(f"{i}", "k" if i < fallbacks else f"k{i}") for i in range(20)], "id string, cache_key string")
    known = used.select("cache_key").distinct().withColumn("status", F.when(F.col("cache_key") == "k", "raw_fallback").otherwise("ok"))
    assert (cache.release_errors(used, known).count() == 0) == passes


def test_last_record_wins(spark):
    rows = spark.createDataFrame([("k", "old", 1), ("k", "new", 2), ("j", "x", 3)], "cache_key string, description string, n int")
    assert {(r.cache_key, r.description) for r in cache.latest(rows, F.col("n")).collect()} == {("k", "new"), ("j", "x")}


def test_exact_search(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=(700, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v], i % 3) for i, v in enumerate(e)], "vec_id long, embedding array<double>, label int").repartition(5)
    asked = df.where("vec_id < 40").select(F.col("vec_id").alias("query_id"), "embedding", "label")
    unit = e / np.linalg.norm(e, axis=1, keepdims=True)
    d = 1 - unit[:40] @ unit.T
    for same in (None, "label"):
        found = index.nearest(asked, df, 4, others_only=True, same=same, block=16).collect()
        own = d.copy()
        own[np.arange(40), np.arange(40)] = np.inf
        if same:
            own[np.arange(40)[:, None] % 3 != np.arange(700)[None] % 3] = np.inf
        want = {(q, r + 1, int(v)) for q in range(40) for r, v in enumerate(np.argsort(own[q], kind="stable")[:4])}
        assert {(r.query_id, r.rank, r.vec_id) for r in found} == want
    assert index.nearest(asked.limit(0), df, 4).collect() == []


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)], "vec_id long, embedding array<double>").repartition(4)
    found = index.nearest(df.where("vec_id = 9").select(F.col("vec_id").alias("query_id"), "embedding"), df, 3).collect()
    assert sorted((r.rank, r.vec_id) for r in found) == [(1, 0), (2, 1), (3, 2)]


def test_a_block_is_searched_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    e = np.tile(rng.normal(size=(1500, 64)), (4, 1))  # four of each vector, which tie
    table = pa.table({"id": pa.array(range(6000)), "e": pa.array(list(e)), "s": pa.array([""] * 6000)})
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("distance", pa.float64())])
    tracemalloc.start()
    found = index._block(table.slice(0, 700), table, 5, True, out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    by = {}
    for q, v, d in zip(*(c.to_pylist() for c in found.columns)):
        by.setdefault(q, []).append((d, v))
    unit = e / np.linalg.norm(e, axis=1, keepdims=True)
    d = 1 - unit[:700] @ unit.T
    d[np.arange(700), np.arange(700)] = np.inf
    for q in range(700):
        near = sorted(by[q])
        assert [v for _, v in near[:3]] == [q + 1500, q + 3000, q + 4500] and len({x for x, _ in near[:3]}) == 1
        assert np.allclose([x for x, _ in near[:5]], np.sort(d[q])[:5])


GROUPS = [("q1", 0, "Page One", ["<mark>", "other"]), ("q1", 1, "page-two", []), ("q2", 0, "page one", ["mark", "<other>"]), ("q3", 0, "nowhere", ["x"])]
HITS = [("q1", 1, "http://x/page%2Done", "no", 0.2, "official", "c1"), ("q1", 2, "page_one", "has <mark>", 0.3, "companion", "c2"), ("q2", 1, "pageone", "a mark", 0.5, "official", "c3")]
HIT = "query_id string, position int, page_key string, content string, distance double, source_type string, chunk_id string"


def test_suite(spark):
    groups = spark.createDataFrame(GROUPS, schemas.EVAL_GROUP)
    found = {(r.query_id, r.group_index): r for r in evaluate.run_suite(spark.createDataFrame(HITS, HIT), groups).collect()}
    assert (found["q1", 0].rank, found["q1", 0].distance, found["q1", 0].status, found["q1", 0].rank1_source_type) == (2, 0.3, "ok", "official")
    assert found["q1", 1].hit is False and found["q2", 0].status == "low_confidence" and found["q3", 0].status == "no_match"
    results = spark.createDataFrame(list(found.values()), schemas.RESULT)
    assert len({r.identity for r in found.values()}) == 4
    best = {r.query_id: r.rank for r in evaluate.best_groups(results).collect()}
    assert best == {"q1": 2, "q2": 1, "q3": None}
    assert evaluate.compare_results(results, results).collect() == []
    other = results.withColumn("distance", F.col("distance") + 0.00005)
    assert evaluate.compare_results(results, other).collect() == []
    worse = results.withColumn("distance", F.col("distance") + 0.001).where("query_id <> 'q3'")
    assert {(r.query_id, r.failure) for r in evaluate.compare_results(results, worse).collect()} == {("q1", "distances"), ("q2", "distances"), ("q3", "groups")}


def test_identity_ignores_brackets_and_order(spark):
    df = spark.createDataFrame([("p", ["<b>", "a"]), ("p", ["a", " b"])], "page_match string, markers array<string>")
    assert df.select(C.group_identity(df.page_match, df.markers)).distinct().count() == 1


def test_fixture_integrity(spark):
    chunks = spark.createDataFrame([("doc/page-one", 0, "whole marker here"), ("doc/page-one", 1, "first half"), ("doc/page-one", 2, "second  half")], "page_key string, chunk_index int, content string")
    groups = spark.createDataFrame([("a", 0, "page one", ["marker here"]), ("b", 0, "page one", ["half second half"]), ("c", 0, "page one", ["zzz"]), ("d", 0, "no page", []), ("e", 0, "PageOne", [])], schemas.EVAL_GROUP)
    assert {(r.query_id, r.error) for r in evaluate.fixture_errors(chunks, groups).collect()} == {("b", "split"), ("c", "missing"), ("d", "missing")}


def test_holdout(spark):
    chunks = spark.createDataFrame([("c1", "r", 0, 100, "Head"), ("c2", "r", 100, 200, "Other  head"), ("c3", "s", 0, 9, "Head")], "id string, source_record_id string, source_start_byte long, source_end_byte long, section_heading string")
    targets = spark.createDataFrame([("q", "t", "f", 0, "r", 90, 110, None), ("q", "t", "f", 1, "r", 300, 310, None), ("q", "t", "f", 2, "r", None, None, "other HEAD")], schemas.HOLDOUT_TARGET)
    assert {(r.target_index, r.id) for r in evaluate.match_holdout(targets, chunks).collect()} == {(0, "c1"), (0, "c2"), (2, "c2")}
    hits = spark.createDataFrame([("q", 1, "", "", 0.1, "official", "c3"), ("q", 2, "", "", 0.4, "x", "c2")], HIT)
    found = {r.group_index: (r.rank, r.hit, r.status) for r in evaluate.run_holdout(hits, targets, chunks).collect()}
    assert found == {0: (2, True, "ok"), 1: (None, False, "ok"), 2: (2, True, "ok")}


FOUND = dict(hit=True, distance=0.2, rank=1, rank1_source_type="official", status="ok")


def results(spark, **changes):
    rows = []
    for q in {*gates.PRIMARY, *gates.OFFICIAL, *gates.EXPOSED}:
        for g in range(2 if q in ("T03", "I01") else 1):
            own = FOUND | changes.get(f"{q}_{g}", {}) | changes.get(q, {})
            rows.append((q, own["status"], own["rank1_source_type"], g, f"{q}{g}", own["rank"], own["distance"], own["hit"]))
    return spark.createDataFrame(rows, schemas.RESULT)


MISS = dict(hit=False, distance=None, rank=None)


def failures(report):
    return sorted({r.gate for r in report.where("severity = 'failure'").collect()})


def test_full_release(spark):
    good = results(spark)
    assert failures(gates.full_release(good, good)) == [] and gates.verdict(gates.full_release(good, good)).first().passed
    assert failures(gates.full_release(results(spark, G02=MISS), good)) == []
    assert failures(gates.full_release(results(spark, G02=MISS, G03=MISS), good)) == ["generic"]
    assert failures(gates.full_release(results(spark, I01_1=MISS), good)) == ["identifier-regression"]
    assert failures(gates.full_release(results(spark, G01={"status": "low_confidence"}), good)) == ["rescue"]
    assert failures(gates.full_release(results(spark, O03={"rank": 4}), good)) == ["official"]
    assert failures(gates.full_release(results(spark, O03={"rank1_source_type": "companion"}), good)) == ["official"]
    assert failures(gates.full_release(results(spark, T03_1=MISS), good)) == ["mandatory"]
    assert failures(gates.full_release(results(spark, E03=MISS), good)) == ["exposed"]
    slow = {q: {"rank": 3} for q in gates.PRIMARY if q != "G01"}
    assert failures(gates.full_release(results(spark, **slow), good)) == ["companion"]
    missed = results(spark, I01_1=MISS)
    assert [r.severity for r in gates.identifier_regression(missed, missed).collect()] == ["advisory"]


def test_fallback_release(spark):
    base = results(spark, G01={"distance": 0.4, "rank": 3}, T02={"distance": 0.3})
    good = results(spark)
    assert failures(gates.fallback_release(good, base, good)) == []
    assert failures(gates.fallback_release(good, good, good)) == ["generic", "task"]
    assert failures(gates.fallback_release(good, base, good, built=False)) == ["build"]
    assert failures(gates.fallback_release(results(spark, T04=MISS), base, good)) == ["regression"]
    assert failures(gates.fallback_release(results(spark, E02=MISS), base, good)) == ["recall"]
    assert failures(gates.fallback_release(results(spark, I06={"rank": 3}), base, good)) == ["identifier"]


def holdout_results(spark, **changes):
    rows = []
    for f in (gates.GENERIC_FAMILY, *gates.OTHER_FAMILIES, gates.OFFICIAL_FAMILY):
        own = FOUND | changes.get(f, {})
        rows.append((f"h_{f}", f, own["status"], own["rank1_source_type"], 0, own["rank"], own["distance"], own["hit"]))
    return spark.createDataFrame(rows, "query_id string, family string, status string, rank1_source_type string, group_index int, rank int, distance double, hit boolean")


def test_holdout_gates(spark):
    good = holdout_results(spark)
    assert failures(gates.holdout_full(good)) == [] and failures(gates.holdout_fallback(good, good)) == []
    far = holdout_results(spark, set_document_property={"distance": 0.6})
    assert failures(gates.holdout_full(far)) == [] and gates.holdout_full(far).where("severity = 'advisory'").count() == 2
    assert failures(gates.holdout_full(holdout_results(spark, groovy_stream={"status": "no_match"}))) == ["holdout"]
    assert failures(gates.holdout_full(holdout_results(spark, official=MISS))) == ["holdout", "holdout-official"]
    worse = holdout_results(spark, groovy_stream={"rank": 4, "status": "low_confidence"})
    assert failures(gates.holdout_fallback(worse, good)) == ["holdout-regression"]
    assert failures(gates.holdout_fallback(worse, holdout_results(spark, groovy_stream=MISS | {"status": "no_match"}))) == []
    with pytest.raises(Exception, match="no result of family"):
        gates.holdout_full(good.where("family <> 'groovy_stream'")).collect()


def test_manifest(spark):
    row = ("u", "http://a.b/c", "p1", "official", "", "", "", ""), ("v", "https://d.e/", "p2", "companion_reference", "r", "c", "s1", "Ref > Steps > T"), ("v", "", "p2", "companion_reference", "r", "c", "s2", "Ref > T")
    df = spark.createDataFrame(row, "category string, source_url string, page_key string, source_type string, upstream_repo string, upstream_commit string, source_path string, breadcrumb string")
    found = index.manifest(df, "http://none").first()
    document = index.manifest_document(found, model="m", dimensions=3, candidate="b567", snapshot_sha="s")
    assert document["chunk_count"] == 3 and document["page_count"] == 2 and document["category_counts"] == {"u": 1, "v": 2} and document["source_roots"] == ["http://a.b", "https://d.e"]
    assert document["companion"] == {"repo": "r", "commit": "c", "chunk_count": 2, "file_count": 2, "area_counts": {"Steps": 1}} and document["embedding_contract"]["s7_enabled"]
    with pytest.raises(ValueError):
        index.manifest_document(found, model="m", dimensions=3, candidate="b56")
    assert json.dumps(document)
