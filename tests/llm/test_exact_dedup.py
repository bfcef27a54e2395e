import hashlib
import re
from collections import Counter

import pytest

from sparkloom.llm.common import drop_tables, shared_dir, tables
from sparkloom.llm.exact_dedup import DigestIndex, buckets_for, exact_dedup


def brute(rows):
    digests = [(i, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()) for i, t, *_ in rows]
    out = []
    for i, d in digests:
        own = [j for j, e in digests if e == d]
        keep = min((j for j in own if j is not None), default=None)
        out.append((i, keep, len(own), i == keep and (i, d) not in {x[::4] for x in out}, d))
    return Counter(out)


def test_against_brute_force(docs, rows, empty):
    assert Counter(map(tuple, exact_dedup(docs).collect())) == brute(rows)
    assert exact_dedup(empty).collect() == []


def test_index_persists_and_grows(spark, tmp_path):
    path = str(tmp_path / "index")
    schema = "doc_id long, text string"
    first = exact_dedup(spark.createDataFrame([(5, "a"), (6, "b")], schema), DigestIndex(spark, path, buckets=4))
    assert {(r.doc_id, r.keep_id, r.kept) for r in first.collect()} == {(5, 5, True), (6, 6, True)}
    again = exact_dedup(spark.createDataFrame([(1, "a"), (9, "c"), (2, "c")], schema), DigestIndex(spark, path, buckets=4))
    assert {(r.doc_id, r.keep_id, r.kept) for r in again.collect()} == {(1, 5, False), (9, 2, False), (2, 2, True)}
    assert DigestIndex(spark, path, buckets=4).rows().count() == 3


def test_index_side_needs_no_exchange(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "i"), buckets=4)
    exact_dedup(spark.createDataFrame([(i, str(i)) for i in range(50)], "doc_id long, text string"), index)
    new = spark.createDataFrame([(b"x" * 32, 1)], "digest binary, keep_id long")
    plan = new.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_null_and_repeated_ids_keep_one_row(spark):
    for name in (None, 7):
        data = [(name, f"text {i % 50}") for i in range(2000)]
        found = exact_dedup(spark.createDataFrame(data, "doc_id long, text string")).collect()
        assert sum(r.kept for r in found) == 50 == len({r.text_sha256 for r in found if r.kept})
        assert {r.keep_id for r in found} == {name}


def test_a_row_taken_in_again_goes(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "index"))
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert [r.kept for r in exact_dedup(batch, index).collect()] == [True, True]
    assert [(r.kept, r.keep_id == r.doc_id) for r in exact_dedup(batch, index).collect()] == [(False, True)] * 2


def test_compaction_and_opening_again(spark, tmp_path):
    path = str(tmp_path / "index")
    index = DigestIndex(spark, path, buckets=3)
    for k in range(3):
        exact_dedup(spark.createDataFrame([(i, str(i)) for i in range(20 * k, 20 * k + 30)], "doc_id long, text string"), index)
    held = sorted(map(tuple, index.rows().collect()))
    index.compact()
    assert sorted(map(tuple, index.rows().collect())) == held and len(held) == 70
    assert index.buckets == buckets_for(70) and not (tmp_path / "index" / "0").exists()
    index.close()
    again = DigestIndex(spark, path, buckets=5)
    assert again.buckets == index.buckets and again.rows().count() == 70
    again.drop()
    assert not (tmp_path / "index").exists()


def test_nothing_is_left_after_a_run(spark, docs):
    before, listed = tables(), {t.name for t in spark.catalog.listTables()}
    exact_dedup(docs).collect()
    assert {t.name for t in spark.catalog.listTables()} == listed
    drop_tables(tables() - before)
    assert tables() == before


def test_a_shared_folder_is_asked_for_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
