"""Main text of pages: markup, repeated runs, both ways of removing them."""

from logweir.llm import extract
from logweir.llm.common import table
from logweir.llm.markup import blocks, title


def texts(html):
    return [b.text for b in blocks(html) if not b.boilerplate]


def test_blocks():
    html = (
        "<!doctype html><head><title>T &amp; t</title><style>p{}</style></head><body><!-- <p>no --><p>a<b>b</b> &amp;\n c<br>d"
        "<ul><li>one<li>two</ul><p hidden>no<p style='display: none'>no</p><p title='a>b'>q &lt;tag&gt; < 5&nbsp; 6"
        "<script>if (a</b>) '</p>'</script><table><tr><td>x<td>y</table><img alt='<p>'>end<svg><text>no</text></svg>"
    )
    assert texts(html) == ["ab & c d", "one", "two", "q <tag> < 5 6", "x", "y", "end"]
    assert title(html) == "T & t"
    assert [texts(x) for x in ("", "<", "a <b")] == [[], ["<"], ["a <b"]]
    assert texts("x</p></div>y</article>z") == ["x", "y", "z"]
    assert texts("<script>never closed <p>a") == []


def test_marked_boilerplate():
    html = (
        "<header>h</header><nav><ul><li>n</ul></nav><div class='ad-box'>a</div><div id='comments'><p>c</p></div>"
        "<body class='has-sidebar'><article><header><h1>Head</h1></header><p>Body<p>More<aside>s</aside><form>f<input></form>"
        "<div class='newsletter signup'>n</div><footer>by</footer></article><article class='comment'>r</article><footer>&copy;</footer>"
    )
    assert texts(html) == ["Head", "Body", "More"]
    assert all(b.article for b in blocks(html) if not b.boilerplate)


def test_article_around_which_text_goes(spark):
    html = "<div>stray</div><article><p>Main <i>text</i></p><p>two</p></article><div>tail</div>"
    pages = spark.createDataFrame([(1, "http://a/x", html, 5)], "page_id long, url string, html string, n_chars int")
    (row,) = extract.main_texts(pages).collect()
    assert tuple(row)[:4] == (1, "http://a/x", "Main text two", 13)


def test_article_within_main(spark):
    html = "<main><div>Posted in News</div><article><p>Text</p></article></main>"
    alone = "<div>x</div><main><p>Only</p><div role=article><p>inner</p></div></main>"
    plain = "<div>x</div><main><p>Only main</p></main>"
    pages = spark.createDataFrame([(1, "u", html), (2, "u", alone), (3, "u", plain)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in extract.main_texts(pages).collect()} == {1: "Text", 2: "inner", 3: "Only main"}


def test_a_teaser_does_not_replace_the_story_in_main(spark):
    story = "The council voted on Monday to close the old bridge for good"
    teaser = "<article><h2>Read next</h2><p>Rain expected</p></article>"
    html = f"<nav>n</nav><main><h1>Bridge</h1><p>{story}</p>{teaser}</main>"
    byline = f"<main><p>Written by our staff on a day</p><article><p>{story}</p></article></main>"
    pages = spark.createDataFrame([(1, "http://a/1", html), (2, "http://b/2", byline)], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract.main_texts(pages).collect()}
    assert found == {1: f"Bridge {story} Read next Rain expected", 2: story}


STORY = "The council voted on Monday to close the old bridge for good " * 6


def test_names_do_not_condemn_what_holds_the_article():
    story = STORY.strip()
    wrapped = [
        "<div class='layout right-sidebar'><article><p>{}</p></article></div>",
        "<div class='content-sidebar-wrap'><main><p>{}</p></main></div>",
        "<article class='post comments-open'><p>{}</p></article>",
        "<div id='sidebar'><p>{0}</p><p>{0}</p></div>",
        "<article><section class='social-science'><p>{}</p></section></article>",
        "<article><p>{}</p><p class='alert'>Mind the gap</p><p aria-hidden=true>Seen</p></article>",
    ]
    for html in wrapped:
        nav = "<nav>Home News</nav><div class='ad'>Buy now</div><div id=comments><article>I agree</article></div>"
        found = " ".join(texts(nav + html.format(story)))
        assert found.startswith(story) and "Buy" not in found and "agree" not in found and "Home" not in found
    assert texts(f"<article><p>{story}</p><div class='ad-box'>a</div><ul class='share-links'><li>s</ul></article>") == [story]
    assert texts("<div class='ad'>Only an advert</div>") == []
    assert found.endswith("Mind the gap Seen")


def page(head, body, tail):
    return f"<title>{head}</title><div>{body}</div><div>{tail}</div>"


def own(i):
    return " ".join(f"w{i}x{k}" for k in range(9))


TAIL = "Read our terms and follow us on every network today"


def test_repeated_runs_of_a_host_go(spark):
    rows = [(i, f"http://a.b/{i}", page(f"t{i}", own(i), TAIL)) for i in range(6)]
    rows += [(10 + i, "http://c.d/", page("same title", "a copied page with one and the same text", "x")) for i in range(3)]
    rows += [(20, "http://e.f/", page("other host", "lonely", TAIL)), (21, None, None), (None, "bad", ""), (0, rows[0][1], rows[0][2])]
    rows += [(30, "http://a.b/y", page("t30", "word " * 30_000, "Read our terms and follow us on every network"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = [own(i) for i in [*range(6), 0]]
    want += ["a copied page with one and the same text x"] * 3 + [f"lonely {TAIL}", "", "", ("word " * 30_000).strip()]
    for held in (extract.HELD, 0):
        found = extract.main_texts(pages, held)
        assert found.columns[:4] == ["page_id", "url", "text", "n_chars"]
        assert sorted(r["text"] for r in found.collect()) == sorted(want)
        assert all(r["n_chars"] == len(r["text"]) for r in found.collect())


def test_runs_stop_at_block_borders(spark):
    rows = [(i, f"http://a.b/{i}", page(f"t{i}", f"unique words number {i} of this very page", TAIL)) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for held in (extract.HELD, 0):
        found = {r["page_id"]: r["text"] for r in extract.main_texts(pages, held).collect()}
        assert found == {i: f"unique words number {i} of this very page" for i in range(6)}


def test_everyday_phrases_of_two_pages_stay(spark):
    phrase = "at the end of the day it was over"
    long = " ".join(f"l{k}" for k in range(60))
    bodies = {1: f"{own(1)} {phrase}", 2: f"{phrase} {own(2)}", 3: f"{long} {own(3)}", 4: f"{own(4)} {long}"}
    rows = [(i, f"http://a.b/{i}", page("Blog" if i > 4 else f"t{i}", bodies.get(i, own(i)), TAIL)) for i in range(30)]
    rows += [(100 + i, "http://a.b/copy", rows[1][2]) for i in range(9)]  # copies are one page
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract.main_texts(pages).collect()}
    want = {i: bodies.get(i, own(i)) for i in range(30)} | {3: own(3), 4: own(4)}
    assert found == want | {100 + i: bodies[1] for i in range(9)}


def test_both_ways_agree_on_the_tables(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    one, two = (sorted(map(tuple, extract.main_texts(pages, n).collect())) for n in (extract.HELD, 0))
    assert one == two and len(one) == pages.count()
    assert all(text and n for _, _, text, n, _ in one)


def test_empty_table(spark):
    assert extract.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
