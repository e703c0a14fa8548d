import time

import pytest

from statforge.llm import urls
from statforge.llm.extraction import extract_pages, main_text

PAGES = [
    ('<div class="sidebar"><p>Side, text. here</p></div><div class="content"><h1>T</h1><p>One, two. three <a href=x>li</a>nk.</p><p>Short</p><section class="comments"><p>Nice, really.</p></section></div>', "T One, two. three link. Short"),
    ("<body><header><h1>Site</h1></header><main><article><header><h1>Title</h1><p>By me, today.</p></header><p>Text &amp; more, here.<p>Second.<form><input><p>Sign up, now.</p></form></article></main>", "Title Text & more, here. Second."),
    ("just   text", "just text"),
    ("<p>a<p>b", "a b"),
    ("<p>x<b>y</b>z<br>w", "xyz w"),
    ("<p>1 < 2, &lt;b&gt; &#233;.</p>", "1 < 2, <b> é."),
    ('<div id="cookie-notice">We use, cookies. ok</div><div>Hello, world. This, is.</div><ul class="menu"><li>a</ul>', "Hello, world. This, is."),
    ("<article><p>Real, text.</p><div class='advert'>Buy, this. Now.</div><p>More.</p></article><div class='ad'>Long, long, punctuated. advert, with. many, marks.</div>", "Real, text. More."),
    ('<script>var a = "</p><p>no, script.";</script><style>p{}</style><!-- <p>no, comment.</p> --><p>Yes, text.', "Yes, text."),
    ("<nav><p>only, a menu.</p></nav>", ""),
    ("<div", "<div"),
    (None, ""),
    ("", ""),
    ('<div class="content has-sidebar"><article><p>Real, text. Here.</p></article><div class="sidebar"><p>Side, text.</p></div></div>', "Real, text. Here."),
    ('<div class="layout-header-fixed"><main><p>Real, text. Here.</p></main></div>', "Real, text. Here."),
    ('<p title="a > b">One, two.</p><p title="open>Three, four.</p>', "One, two. Three, four."),
    ("<p>One, two.</p><a href=x", "One, two. <a href=x"),
    ("<p>One, two.</p><a <!-- gone", "One, two. <a"),
    ("<p>" + "long, text. " * 50_000, ("long, text. " * 50_000).strip()),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    ["<a" * 100_000, "<a" * 100_000 + ">", "<div>text" * 20_000, "<x><p>one, two." * 20_000, '<a "b>c" ' * 30_000, "<li>a" * 30_000, "<!x" * 50_000, "<b '\"" * 50_000 + ">", "<script>" * 20_000, "</div>" * 50_000],
)
def test_broken_and_deep_pages_take_linear_time(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 2


def test_pages_table(spark):
    rows = [(1, "u", "<p>é, ü.</p>", "x"), (1, "u", "<p>é, ü.</p>", "x"), (None, None, None, None)]
    out = extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "u", "é, ü.", 5), (1, "u", "é, ü.", 5), (None, None, "", 0)]
    assert extract_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


URLS = [
    ("http://A.Example.COM/en/x?y#z", ("a.example.com", "/en/x", "example.com/en/", "block")),
    ("https://www.example.com/en/1", ("www.example.com", "/en/1", "www.example.com/en/", "allow")),
    ("https://m.www.example.com/en/1", ("m.www.example.com", "/en/1", "www.example.com/en/", "allow")),
    ("https://example.com/de/", ("example.com", "/de/", "com/", "allow")),
    ("https://com/", ("com", "/", "com/", "allow")),
    ("https://notcom", ("notcom", "", None, "allow")),
    ("https://example.com", ("example.com", "", None, "allow")),
    ("http://x.net/es/", ("x.net", "/es/", "net/es/", "block")),
    ("http://x.net/es", ("x.net", "/es", None, "allow")),
    ("http://x.net?q=/fr/", ("x.net", "", None, "allow")),
    ("http://free-porn.example.org/a", ("free-porn.example.org", "/a", None, "block")),
    ("http://pornography.example.org/a", ("pornography.example.org", "/a", None, "allow")),
    ("http://hot.example.org/dating", ("hot.example.org", "/dating", None, "block")),
    ("http://hot.example.org/hot", ("hot.example.org", "/hot", None, "allow")),
    ("no scheme", ("", "", None, "allow")),
    ("a://b://c/d", ("b:", "//c/d", None, "allow")),
    ("", ("", "", None, "allow")),
    (None, ("", "", None, "allow")),
]


def test_url_verdicts_equal_sql(spark):
    import duckdb

    out = urls.judge_urls(spark.createDataFrame([(i, u, "h", "r") for i, (u, _) in enumerate(URLS)], "page_id bigint, url string, host string, rule string"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert got == {i: wanted for i, (_, wanted) in enumerate(URLS)}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u) for i, (u, _) in enumerate(URLS)])
    same = connection.execute(f"SELECT page_id, host, path, rule, verdict, strict_hits, soft_hits FROM ({urls.url_sql()})").fetchall()
    assert sorted(same) == sorted((r.page_id, r.host, r.path, r.rule, r.verdict, r.strict_hits, r.soft_hits) for r in out.collect())
    assert urls.judge_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
