import pytest

from sparkloom.functions.tokenizer import BUDGET, QuarterTokenizer
from sparkloom.operators import chunks as K
from sparkloom.operators import rows, validate

LONG = " ".join(f"Sentence number {i} is here." for i in range(400))
WAY = "<p>" + "<strong>Path:</strong> "
PAGES = [
    ("b.html", f"<h1>Root</h1>{WAY}<a href='http://h/r/?x#y'>Root</a></p><p>{'intro words ' * 60}</p><h2>Big</h2><p>{LONG}</p><p>{LONG}</p>"),
    ("a.html", "<h1>Small</h1><p>short</p><h2>Next</h2><p>also short</p><script>no</script>"),
    ("c.html", ""),
    ("d.html", f"<h1>Root again</h1>{WAY}<a href='http://h/r'>Root</a></p><p>more of it</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "file string, html string")


def test_quarter_length_chunks(pages):
    found = K.chunk_pages(pages, least=10, most=1000).orderBy("file", "ord").collect()
    assert [r.id for r in found] == ["a_000", "b_000", "b_001", "b_002", "b_003", "b_004", "d_000"][: len(found)] or len({r.id for r in found}) == len(found)
    by = {}
    for r in found:
        by.setdefault(r.page_key, []).append(r.chunk_index)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert set(by) == {"file:a", "http://h/r"}
    small = next(r for r in found if r.file == "a.html")
    assert small.content == "short\nNext\nalso short\nno" and (small.title, small.category, small.section_heading) == ("Small", "Unknown", "Small")
    big = [r for r in found if r.section_heading == "Big"]
    assert len(big) > 1 and all(r.content.startswith("Big\n") for r in big) and all(r.title == "Root" for r in big)
    assert all(r.token_estimate == len(r.content) // 4 for r in found)


def test_merging_rules():
    d = lambda heading, text, page="p", crumb="": {"heading": heading, "text": text, "html": text, "breadcrumb": crumb, "source_url": crumb, "page_key": page}
    out = K.merge_small([d("T", ""), d("A", "a" * 50, crumb="c"), d("B", "b" * 50, "q"), d("C", "c" * 4, "q")], 10)
    assert [(x["heading"], x["text"], x["breadcrumb"]) for x in out] == [("A", "a" * 50, "c"), ("B", "b" * 50 + "\ncccc", "")]
    assert K.merge_small([], 5) == []


def test_exact_budget_pages(pages):
    found = K.span_chunk_pages(pages).orderBy("file", "ord").collect()
    assert all(r.embedding_token_count <= BUDGET for r in found)
    assert not any("no" == r.content.split("\n")[-1] for r in found)
    records = {}
    for r in found:
        records.setdefault(r.source_record_id, []).append((r.source_start_byte, r.source_end_byte))
    assert set(records) == {"official:http://h/r", "official:file:a"}
    for spans in records.values():
        spans.sort()
        assert all(b[0] >= a[1] for a, b in zip(spans, spans[1:]))
    # the record of a page: heading line and text of its sections, blank lines between
    first = [r for r in found if r.file == "a.html"]
    record = b"Small\nshort\n\nNext\nalso short"
    assert [record[r.source_start_byte : r.source_end_byte] for r in first] == [b"short", b"also short"]
    assert len({r.id for r in found}) == len(found)


MARKDOWN = "# Guide\n\nSome words.\n\n## Use\n\n" + "Prose goes on. " * 200 + "\n\n```xml\n<a>" + "y" * 1600 + "</a>\n```\n\n## Skip\n\nno\n"


@pytest.fixture(scope="module")
def files(spark):
    row = ("x/Guide.md", "", "Steps", 1, None, ["skip"], True, "r", "c" * 40, "raw", "blob", "latest", MARKDOWN)
    return spark.createDataFrame([row], "path string, title string, area string, priority int, sections array<string>, drop_sections array<string>, strip_xml_blocks boolean, upstream_repo string, upstream_commit string, raw_url string, blob_url string, latest_url string, text string")


def test_exact_budget_markdown(files):
    found = K.span_chunk_markdown(files).orderBy("ord").collect()
    assert {r.section_heading for r in found} == {"Guide", "Use"} and all(r.breadcrumb == "Companion Reference > Steps > Guide" for r in found)
    guide = found[0]
    assert MARKDOWN.encode()[guide.source_start_byte : guide.source_end_byte] == b"Some words." and guide.id.startswith("companion_guide_") and guide.id.endswith("_000")
    assert all(r.embedding_token_count <= BUDGET for r in found) and all(r.synthetic_wrapper_metadata.stripped_xml == (r.section_heading == "Use") for r in found)
    assert not any("yyyy" in r.content for r in found)


def test_quarter_length_markdown(files):
    found = K.chunk_markdown(files, least=10, most=400).collect()
    assert all(r.category == "Companion Reference" and r.source_path == "x/Guide.md" for r in found)
    assert sorted(r.chunk_index for r in found) == list(range(len(found)))


def test_no_room_for_text():
    with pytest.raises(ValueError, match="leaves none"):
        K.section_chunks("text", heading="h" * 2000, title="t", breadcrumb="", source_type=K.OFFICIAL, base=0, record="r", path="p", tokenizer=QuarterTokenizer())


def test_contract(pages, files, spark):
    both = K.union_corpora(K.span_chunk_pages(pages), K.span_chunk_markdown(files))
    assert validate.chunk_errors(both).collect() == [] and validate.duplicate_ids(both).collect() == []
    assert validate.lineage_errors(both, "b56").collect() == [] and len(validate.lineage_errors(both, "c0").collect()) == 1
    broken = spark.createDataFrame([("i", "p", " ", 3, "official", "", "", "x", "", ""), ("j", "p", "<n:Component>", None, "companion_reference", "r", "c", "s", "w", None)], "id string, page_key string, content string, chunk_index int, source_type string, upstream_repo string, upstream_commit string, source_path string, raw_url string, latest_url string")
    assert {tuple(r) for r in validate.chunk_errors(broken).collect()} == {
        ("i", "content is empty"), ("i", "official chunk with source_path"), ("j", "chunk_index is missing"), ("j", "companion chunk without latest_url"), ("j", "companion chunk with a raw component"), ("p", "page with gaps in chunk_index"),
    }
    with pytest.raises(ValueError, match="broken"):
        validate.require_none(validate.chunk_errors(broken), "broken")


def test_numbering_of_a_hot_key(spark):
    data = [("hot", f"f{i % 5}", i) for i in range(100)] + [("cold", "f0", 7)]
    found = rows.numbered(spark.createDataFrame(data, "page_key string, file string, ord int"), "page_key", "file", "ord").collect()
    hot = sorted((r.file, r.ord, r.chunk_index) for r in found if r.page_key == "hot")
    assert [x[2] for x in hot] == list(range(100)) and [r.chunk_index for r in found if r.page_key == "cold"] == [0]


def test_pages_and_files_are_split_once(pages, files):
    for made in (K.span_chunk_pages(pages), K.span_chunk_markdown(files)):
        assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
