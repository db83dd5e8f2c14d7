"""Site-relative line dedup."""

from collections import Counter

import duckdb
import pytest

from logweir.llm import lines
from logweir.llm.common import table


def brute(data, ratio=lines.RATIO):
    pages = {(site, text or "") for _, text, site, *_ in data}
    held, total = Counter(), Counter()
    for site, text in pages:
        total[site] += 1
        held.update({(site, x.strip(" ")) for x in text.split("\n") if x.strip(" ")})
    bad = {k for k, n in held.items() if n >= 2 and n > ratio * total[k[0]]}
    out = []
    for i, text, site, *_ in data:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if (site, x.strip(" ")) not in bad]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


def rows_of(found):
    return sorted((tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def sites():
    """Repeated and null ids, a null site, small sites, a group of copies of a tenth of its site."""
    data = [(i, f"menu\ntext {i}\n  menu  \n\nfoot {i % 3}", "a" if i % 2 else None, "x") for i in range(40)]
    data += [(50, None, "b", "x"), (51, "", "b", "x"), (52, "menu", "b", "x"), (None, "menu\nq", "a", "x"), data[1], data[1]]
    data += [(53, "long\n" * 20_000 + "menu", "a", "x"), (54, "menu\n", "a", "x"), (None, None, None, "x")]
    data += [(60 + 10 * n + k, f"top\nonly {k}\nend {k // 2}", f"small {n}", "x") for n in (2, 3, 4) for k in range(n)]
    data += [(200 + k, f"own {k}", "copies", "x") for k in range(90)] + [(300 + k, "copied\nlines", "copies", "x") for k in range(10)]
    return data + [(7, f"other text {k}", "b", "x") for k in range(6)]


@pytest.mark.parametrize("ratio", [lines.RATIO, 0.4])
def test_lines_of_a_site(spark, ratio):
    pages = spark.createDataFrame(sites(), "doc_id long, text string, source string, N_LINES string")
    found = lines.drop_lines(pages, ratio=ratio)
    assert found.columns == ["doc_id", "source", "text", "n_lines", "n_dropped"]
    assert rows_of(found) == brute(sites(), ratio)


def test_sql_is_the_operator(spark):
    pages = spark.createDataFrame(sites(), "doc_id long, text string, source string, other string")
    con = duckdb.connect()
    con.register("documents", pages.toArrow())
    assert sorted(map(tuple, con.execute(lines.SQL).fetchall()), key=str) == rows_of(lines.drop_lines(pages))


def test_a_group_of_copies_keeps_its_lines_and_a_menu_goes(spark):
    pages = spark.createDataFrame(sites(), "doc_id long, text string, source string, other string")
    found = {r["doc_id"]: r["text"] for r in lines.drop_lines(pages).collect() if r["doc_id"] is not None}
    assert found[300] == "copied\nlines"
    # On two of two, three and four pages; "end 1" is on one page of three.
    assert found[80] == found[90] == found[100] == "only 0"
    assert found[92] == "only 2\nend 1"


def test_lines_of_hosts(spark):
    """Lines of raw pages by host."""
    pages = table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "html", lines.host().alias("site"))
    data = [(r["page_id"], r["html"], r["site"]) for r in pages.collect()]
    found = lines.drop_lines(pages, "html", "site").selectExpr("page_id as doc_id", "html as text", "n_lines", "n_dropped")
    want = brute(data)
    assert rows_of(found) == want
    assert any(r[3] for r in want)


def test_hosts(spark):
    urls = [("http://A.b.c/x", "a.b.c"), ("https://m.d:8080?q", "m.d"), ("ftp://h#f", "h"), ("nothing", None), (None, None)]
    found = spark.createDataFrame(urls, "url string, host string").select("host", lines.host().alias("got")).collect()
    assert [r["got"] for r in found] == [r["host"] for r in found]


def test_empty_table(spark):
    assert lines.drop_lines(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
