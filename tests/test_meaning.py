import pytest

from sparkloom.functions import header
from sparkloom.functions import identifiers as I
from sparkloom.functions.tokenizer import QuarterTokenizer

T = QuarterTokenizer()


def head(title, crumb, first="other", kind=header.COMPANION, cap=header.CAP):
    return header.build(kind, title, crumb, first, T, cap)


def test_header_lines_and_cap():
    assert head("Epsilon Function", "Alpha > Beta > Gamma > Delta", cap=12)[1:] == ("Beta > Gamma > Delta\nEpsilon Function", 11)
    assert head("Epsilon Function", "Alpha > Beta > Gamma > Delta", cap=4).lines == ("Epsilon Function",)
    with pytest.raises(header.TitleTooLongError) as e:
        head("Epsilon Function", "A > B", cap=3)
    assert (e.value.tokens, e.value.cap) == (4, 3)
    with pytest.raises(ValueError):
        head("t", "", kind="blog")


def test_header_says_nothing_twice():
    assert head("Map Functions", "Ref > Map functions").lines == ("Ref", "Map Functions")
    assert head("Map Functions", "Ref > Map Functions", "MAP   FUNCTIONS Overview").lines == ("Ref",)
    assert head("Map", "Map", "map") == ((), "", 0)
    assert head("Straße", "x > STRASSE").lines == ("x", "Straße")
    assert head("Same", "same", "z").lines == ("Same",)
    assert head("T", "ignored > here", kind=header.OFFICIAL).lines == ("T",)


def test_code_share():
    prose = " ".join(["abcd"] * 8)
    assert I.code_ratio(f"{prose}\n```\n" + " ".join(["abcd"] * 6) + "\n```", T) == 0.5
    assert I.code_ratio("", T) == 0.0 and I.code_ratio("```\nabcd\n```", T) == 1.0
    assert I.code_segments("a `b` c\n```x\ny\n~~~\n") == ["`b`", "```x\ny\n~~~\n"]


def test_identifiers_of_words_and_markup():
    assert I.identifiers('<ns:Function type="DocumentPropertySet" xsi:type="execute">') == ["DocumentPropertySet", "execute", "ns:", "ns:Function", "xsi:"]
    assert I.identifiers("Plain prose with Words.") == []
    assert I.identifiers("use a.b_c and dataContext, FooBar or X_Y2") == ["FooBar", "X_Y2", "a.b_c", "b_c", "dataContext"]
    assert I.identifiers('<a subtype="x" data-type="y" xmlns:q="u" v="z:w=1"/>') == ["a", "q:"]
    assert I.identifiers("<?xml?> a < b <!-- <c> -->") == ["c"]


def test_facts():
    text = '<ns:Query xmlns:ns="u"><Group xsi:type="Grouping"/></ns:Query> and <Other type=\'T\'/>'
    assert I.facts(text) == (["ns:Query", "Other"], ["Grouping", "T"], ["ns:", "xsi:"])


def test_eligibility():
    code = "```\nfooBar.bazQux(a_b)\n```"
    assert I.is_eligible(header.COMPANION, code, T) and not I.is_eligible(header.OFFICIAL, code, T)
    assert not I.is_eligible(header.COMPANION, "words " * 50 + code, T) and not I.is_eligible(header.COMPANION, "```\nplain\n```", T)


def errors(text, document="<ns:Root type='Kind'><ns:X/></ns:Root>", topic="Map"):
    found = I.description_errors(text, document=document, known=I.identifiers(document), topic=topic, about=I.facts(document), tokenizer=T)
    return sorted({e.split(":")[0] for e in found})


def test_descriptions():
    assert errors("The map uses ns:Root of kind Kind.") == []
    assert errors("A map with ns:root and KIND here.") == []
    assert errors("Nothing here.") == ["mandatory"] and errors("") == ["mandatory", "shape"]
    assert errors("Map. Two. Three. Four ns:Root Kind.") == ["shape"]
    assert errors("Map ns:Root Kind <ns:X> ``` x") == ["shape"] and errors("Map ns:Root Kind " + "longword " * 70) == ["shape"]
    assert errors("The map of fooBar, ns:Root, Kind.") == ["introduced_identifier"]


def test_word_pieces_of_a_vocabulary(tmp_path):
    """A real WordPiece tokenizer, made from a vocabulary by hand: greedy longest pieces, unknown words whole."""
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    from sparkloom.functions.tokenizer import LibraryTokenizer

    words = ["[UNK]", "[CLS]", "[SEP]", "map", "##ping", "##s", "node", "a", ".", "un", "##map", "##ped"]
    made = Tokenizer(models.WordPiece({w: i for i, w in enumerate(words)}, unk_token="[UNK]"))
    made.normalizer, made.pre_tokenizer = normalizers.BertNormalizer(), pre_tokenizers.BertPreTokenizer()
    made.enable_truncation(4)
    made.save(str(tmp_path / "t.json"))
    counter = LibraryTokenizer(str(tmp_path / "t.json"))
    for text, n in (("", 0), ("Mapping", 2), ("mappings a node.", 6), ("unmapped", 3), ("strange words", 2), ("maps " * 50, 100)):
        assert counter.count(text) == n


def test_the_sample_of_a_tree_is_asked_for(spark):
    from sparkloom.operators import tree

    asked = []
    nodes = tree.nodes(spark, [{"url": f"https://h/{i}"} for i in range(30)])

    def get(url):
        asked.append(url)
        return (404 if url.endswith("7") else 200), "text/html", "x"

    found = tree.unreachable(nodes, get, 30, 0.0, lambda s: None).collect()
    assert {(r.url, r.status) for r in found} == {(f"https://h/{i}", 404) for i in (7, 17, 27)}


def test_edges_in_a_circle_are_refused(spark):
    import pytest

    from sparkloom.operators import tree

    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(9)], "n int, p int")
    found = {(r.node, r.ancestor, r.distance) for r in tree.closure(chain, "n", "p").collect()}
    assert found == {(i, j, i - j) for i in range(9) for j in range(i + 1)}
    with pytest.raises(ValueError):
        tree.closure(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "n int, p int"), "n", "p")


def test_search_of_zero_and_null_vectors(spark):
    from sparkloom.operators import index

    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    asked = vectors.withColumnRenamed("vec_id", "query_id")
    for blocks in ({}, {"block": 2, "vector_block": 1}):
        found = {(r.query_id, r.rank): (r.vec_id, round(r.distance, 6)) for r in index.nearest(asked, vectors, 2, **blocks).collect()}
        assert found == {(1, 1): (1, 0.0), (1, 2): (2, 1.0), (2, 1): (1, 1.0), (2, 2): (2, 1.0), (4, 1): (4, 0.0), (4, 2): (1, 1.0)}


def test_markers_split_over_many_chunks(spark):
    from sparkloom.operators import evaluate

    words = [f"w{i}" for i in range(400)]
    chunks = spark.createDataFrame([("page", i, " ".join(words[3 * i : 3 * i + 3])) for i in range(133)], "page_key string, chunk_index int, content string")
    groups = [("a", 0, "page", [" ".join(words[10:60])]), ("b", 0, "page", ["w5"]), ("c", 0, "page", ["w60 w59"]), ("d", 0, "other", []), ("e", 0, "page", ["w1 w2\nw3"]), ("f", 0, "pa", [])]
    wanted = spark.createDataFrame(groups, "query_id string, group_index int, page_match string, markers array<string>")
    for stretch in (evaluate.STRETCH, 17, 64):
        found = {r.query_id: r.error for r in evaluate.fixture_errors(chunks, wanted, stretch).collect()}
        assert found == {"a": "split", "c": "missing", "d": "missing", "e": "split"}
