from collections import Counter

import corpus_pipeline
import pytest

from sparkloom.llm.common import drop_tables, tables
from tests.llm.test_exact_dedup import brute as brute_dedup
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import expected as brute_near


def write(spark, rows, path):
    data = [(i, t, lang, s, len(t or ""), "clash", 0, "x") for i, t, lang, s in rows]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, size string, _row string, digest string")
    df.coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_every_stage_against_brute_force(spark, rows, tmp_path):
    docs = write(spark, rows, str(tmp_path / "documents.parquet"))
    told = stage("language_id")(spark, docs, "")
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter(r.doc_id for r in told.collect()) == Counter(r[0] for r in lettered)

    unique = stage("exact_dedup")(spark, docs, "").collect()
    groups = {k[4] for k in brute_dedup(rows)}
    assert len(unique) == len(groups)
    assert Counter(r.doc_id for r in unique) == Counter({k[1] for k in brute_dedup(rows)} - {None}) + Counter([None])

    near = stage("simhash_dedup")(spark, docs, "").collect()
    assert {r.doc_id for r in near} == {k[2] for k in brute_near(rows)}
    assert len(near) == len({k[2] for k in brute_near(rows)})

    mixed = stage("mix_sources")(spark, docs, "")
    assert mixed.columns == docs.columns
    assert all(n <= 2 * sum(r[0] == i for r in rows) for i, n in Counter(r.doc_id for r in mixed.collect()).items())
    check_packing(stage("packing")(spark, docs, "").collect(), rows)


def test_run(spark, rows, tmp_path):
    write(spark, rows, str(tmp_path / "documents.parquet"))
    first = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert first and Counter(map(tuple, first)) == Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty(spark, rows, tmp_path, name):
    docs = write(spark, rows, str(tmp_path / "d.parquet")).limit(0)
    assert stage(name)(spark, docs, "").collect() == []


def test_letterless_texts_go_without_a_model(spark, rows, tmp_path):
    docs = write(spark, [(i, t, None, s) for i, t, _, s in rows], str(tmp_path / "d.parquet"))
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter(r.doc_id for r in stage("language_id")(spark, docs, "").collect()) == Counter(r[0] for r in lettered)


@pytest.mark.parametrize("name", ["exact_dedup", "simhash_dedup"])
def test_copies_go_from_what_is_no_file_scan(spark, name):
    docs = spark.createDataFrame([(i, "the same few words in all of them") for i in range(4)], "doc_id long, text string")
    assert [r.doc_id for r in stage(name)(spark, docs, "").collect()] == [0]


def test_a_missing_language_is_filled_in(spark, rows, tmp_path):
    docs = write(spark, rows, str(tmp_path / "d.parquet"))
    stated = Counter((r.doc_id, r.lang) for r in docs.where("lang IS NOT NULL").collect())
    told = stage("language_id")(spark, docs, "").collect()
    assert all(r.lang for r in told) and {r.lang for r in told} <= {"en", "de", "fr"}
    assert Counter((r.doc_id, r.lang) for r in told if (r.doc_id, r.lang) in stated) <= stated


def test_only_decisions_are_left_behind(spark, rows, tmp_path):
    docs = write(spark, rows, str(tmp_path / "d.parquet"))
    for name in ("exact_dedup", "simhash_dedup"):
        before = tables()
        stage(name)(spark, docs, "").collect()
        left = tables() - before
        assert [t.rsplit("/", 1)[1] for t in left] == ["dropped"]
        drop_tables(left)


def test_packing_begins_with_small_heaps(spark, rows, tmp_path):
    docs = write(spark, rows, str(tmp_path / "documents.parquet"))
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    whole = lambda: sum(b.getCollectionCount() for b in beans() if "Young" not in b.getName() and "Concurrent" not in b.getName())
    before = whole()
    stage("packing")(spark, docs, "")
    assert whole() > before
