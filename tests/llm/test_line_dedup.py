import pytest

from sparkloom.llm.line_dedup import dedup_lines, host_of

SCHEMA = "page_id long, url string, html string, host string, lines int"


@pytest.mark.parametrize("most", [50_000, 0])
def test_boilerplate_goes_within_its_host_only(spark, most):
    pages = [(i, f"https://www.A.example/{i}", f"<nav>Menu</nav><script>Menu\n</script><p>Own  text {i}</p><div>Menu</div>", "x", 0) for i in range(40)]
    pages += [(100 + i, f"http://b.example:80/{i}", f"<p>Menu</p><p>b {i}</p>" if i == 0 else f"<p>b {i}</p>", "x", 0) for i in range(20)]
    pages += [(200, None, None, None, 0), (201, "nonsense", "", None, 0), (202, "http://c.example/", "bare <b>te</b>xt<br>line", None, 0), (202, "http://c.example/", "bare <b>te</b>xt<br>line", None, 0)]
    found = dedup_lines(spark.createDataFrame(pages, SCHEMA), broadcast_rows=most).collect()
    assert len(found) == len(pages)
    by = {r.page_id: r for r in found}
    assert by[7].text == "Own text 7" and (by[7].n_lines, by[7].n_dropped, by[7].host) == (3, 2, "a.example")
    assert by[100].text == "Menu\nb 0" and by[100].n_dropped == 0
    assert (by[200].text, by[200].n_lines, by[200].host) == ("", 0, "") and by[201].text == ""
    assert by[202].text == "bare text\nline"
    assert dedup_lines(spark.createDataFrame(pages, SCHEMA).limit(0)).collect() == []


def test_hosts(spark):
    urls = ["HTTP://User@WWW.X.example:8080/a", "x", None, "ftp://y.example?q", "//z.example/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(host_of(df.u)).collect()] == ["x.example", "", "", "y.example", ""]
