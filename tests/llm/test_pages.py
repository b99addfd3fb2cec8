"""URL rules and HTML extraction."""

from __future__ import annotations

import random

import pytest
from compare import SMALL as FOLDER
from compare import connect, difference

from tradeloom.llm import html_extraction, url_filter
from tradeloom.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", oracle_sql())
def test_query_equals_sql(llm, name):
    assert difference(queries()[name](llm, FOLDER), connect(FOLDER), oracle_sql()[name]) is None


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_nested_rules(llm, partitions):
    """Random nested rules, with ranges that begin inside open rules."""
    random.seed(int(partitions))
    hosts = ["org", "a.org", "b.a.org", "com", "x.com"]
    paths = ["/", "/p", "/p/q", "/p/q/", "/p/q/r", "/z"]
    rules = list({(random.choice(hosts), random.choice(paths)): random.choice(["allow", "block"]) for _ in range(18)}.items())
    urls = [f"http{random.choice(['', 's'])}://{random.choice(['', 'W.', 'a.', 'b.a.'])}{random.choice(['ORG', 'com', 'x.com', 'porg'])}{random.choice(['', *paths, '/p/q/r/s', '/y'])}{random.choice(['', '?x=/p', '#f'])}" for _ in range(250)]
    urls += [None, "", "no scheme", "://", "http://", "http:///p", "http://org", "http://org/p\nq", urls[0], urls[0]]
    judged = url_filter.judge(
        llm.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS key"),
        llm.createDataFrame([(*k, v) for k, v in rules], "host string, path string, verdict string"),
    )
    llm.conf.set("spark.sql.shuffle.partitions", partitions)
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", "8")
        llm.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
            host, rest = rest[:end].lower(), rest[end:]
            path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
        fits = [(len(h + p), h + p, v) for (h, p), v in rules if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
        expected = max(fits) if fits else (0, None, "allow")
        assert found[i] == (host, path, expected[1], expected[2]), url


def test_no_rules_and_no_pages(llm):
    pages = llm.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = llm.createDataFrame([("org", "/", "block"), ("org", "/", "allow")], "host string, path string, verdict string")
    assert [tuple(r) for r in url_filter.judge(pages, rules.limit(0)).collect()] == [(1, "http://a.org/", "a.org", "/", None, "allow")]
    assert url_filter.judge(pages.limit(0), rules).collect() == []
    assert url_filter.judge(pages, rules).first().verdict == "block"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>x";</script></head><body>
<nav><ul><li><a href="/">menu words here</a></li></ul></nav><div class="ad banner-1">buy this now</div>
<div id="cookie-notice">we use cookies</div><div class="content c{n}"><h1>Head &amp; line</h1><p>First
   text <b>bold</b> &#233;&nbsp;end.<p>Second one, {body}<br>goes on</p><form>send me</form></div>
<aside>side text</aside><div class="comments"><p>{comment}</p></div><footer>&copy; foot</footer></body></html>"""


def text_of(body):
    return f"Head & line\nFirst text bold é end.\nSecond one, {body} goes on"


def test_extraction(llm):
    long = "word " * 50_000
    rows = [(i, f"http://h.org/{i}", PAGE.format(n=i, body=f"body {i} " * 5, comment="reader says " * i)) for i in range(8)]
    rows += [
        (20, "http://h.org/cut", rows[0][2][: rows[0][2].index("goes on")]),
        (21, None, None), (22, "http://e.org", ""), (23, "x", "no tags &lt;at&gt;   all"), (24, "http://l.org", f"<p>{long}</p>"),
        (25, "http://d.org", "<div>" * 3000 + "deep" + "</div>" * 2999), (26, "http://h.org/26", "<article><p>other layout of a page</article>"),
        (27, "http://m.org", "<p>a<p>b</div></p>c<td>d <a href='x>y'>e</a> & &bogus; <"), rows[1],
    ]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS host", "2 AS path", "3 AS winner")
    found = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    for i in range(8):
        assert found[i] == text_of((f"body {i} " * 5).strip()), i
    assert found[20] == text_of(("body 0 " * 5).strip()).replace(" goes on", "")
    assert (found[21], found[22], found[23]) == ("", "", "no tags <at> all")
    assert found[24] == long.strip() and found[25] == "deep" and found[26] == "other layout of a page"
    assert found[27] == "a\nb\nc\nd e & &bogus; <"
    assert html_extraction.extract(pages.limit(0)).collect() == [] and html_extraction.extract(pages).count() == len(rows)


def test_consensus_overrules_a_page(llm):
    """A page whose sidebar is longer than its article follows the other pages of its host."""
    page = "<body><div class='main'><p>{}</p></div><div class='box'><p>{}</p></div></body>"
    rows = [(i, "http://a.org/", page.format("article text " * 20, "<a href='x'>more of this</a> " * 20)) for i in range(5)]
    rows.append((9, "http://a.org/9", page.format("short article", "box text " * 30)))
    found = html_extraction.extract(llm.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()}[9] == "short article"


@pytest.mark.parametrize(
    "open_tag",
    [
        '<div style="overflow:hidden">', '<div title="a hidden thing" data-hidden="false">', "<div data-x='class=\"ad\" hidden'>",
        '<div class="content-with-sidebar">', '<div class="c" class="ad">', '<article class="share post">', '<main id="no-comments" class="widget">',
    ],
)
def test_values_are_no_names(llm, open_tag):
    """A value is not taken for an attribute, and a page is not dropped for what it has."""
    page = f'<html class="no-menu"><body class="page has-sidebar widget">{open_tag}<p>good <a href="/hidden-lake">lake</a> text</p><div hidden>x</div><p class="c" HIDDEN="">y</p><p aria-hidden=true>z</p></body></html>'
    pages = llm.createDataFrame([(1, "http://a.org/", page)], "page_id long, url string, html string")
    assert [r.text for r in html_extraction.extract(pages).collect()] == ["good lake text"]


ARTICLE = " ".join(f"sentence {i} of the article goes on" for i in range(16))


def texts_of(llm, pages):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    found = html_extraction.extract(llm.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


@pytest.mark.parametrize(
    "before,after",
    [
        ('<form id="aspnetForm">', "</form>"), ('<div class="elementor-widget-container">', "</div>"), ('<div class="social-science-article">', "</div>"),
        ('<div class="post tags-list">', "</div>"), ("<aside><article>", "</article>"), ('<div class="sidebar">', "</div>"), ('<div role="navigation">', "</div>"),
    ],
)
def test_a_name_does_not_outweigh_the_text(llm, before, after):
    page = f'<body><nav><a href="/">menu</a></nav>{before}<p>{ARTICLE}</p>{after}<div class="ad">buy now</div><footer>end</footer></body>'
    assert texts_of(llm, [("http://a.org/", page)]) == [ARTICLE]


def test_suspected_parts_stay_out(llm):
    """Long comments, a long footer on a short page and a text cut into widgets, judged by the host's pages."""
    comments = "<div class='comments'><p>" + "a reader says a lot " * 60 + "</p></div>"
    page = "<body><main><p>{}</p></main>{}<footer><p>" + "imprint and terms " * 12 + "</p></footer></body>"
    pages = [("http://c.org/", page.format(ARTICLE, comments)) for _ in range(6)] + [("http://c.org/s", page.format("short one", ""))]
    widgets = "<body>" + "".join(f"<div class='box-widget'><p>{ARTICLE} {i}</p></div>" for i in range(4)) + "<div class='ad-widget'>buy</div></body>"
    pages += [("http://w.org/", widgets)] * 3
    found = texts_of(llm, pages)
    assert found[:6] == [ARTICLE] * 6 and found[6] == "short one"
    assert found[7:] == ["\n".join(f"{ARTICLE} {i}" for i in range(4))] * 3


def test_generated_sites(llm):
    """Sites of other layouts, names and clutter: the planted article on nearly every page, and no page is empty."""
    random.seed(11)
    wraps = ["form", "div class='{}-content'", "section id='{}'", "div class='{} main-wrap'", "div", "main class='{}'", "div data-{}='1'"]
    words = ["widget", "social", "post", "share", "promo-text", "entry", "sidebar-none", "login-page", "related-topic", "story", "c12", "tags-list"]
    clutter = ["<nav><ul><li><a href='/a'>home</a><li><a href='/b'>about us</a></ul></nav>", "<div class='ad'>buy this {}</div>", "<aside><p>side note {}</p></aside>", "<div id='cookie-notice'><p>we use cookies {}</p></div>", "<header><h2>Site {}</h2></header>"]
    expected, pages = [], []
    for site in range(40):
        layers = [random.choice(wraps).format(random.choice(words)) for _ in range(random.randint(1, 4))]
        before, after = random.choices(clutter, k=3), ["<div class='comments'><p>reader {}</p></div>", "<footer><p>all rights {}</p></footer>"]
        for n in range(4):
            text = [" ".join(random.choices(["alpha", "beta", "gamma", "delta", "of", "the"], k=random.randint(30, 80))) for _ in range(random.randint(2, 6))]
            body = "".join(f"<{layer}>" for layer in layers) + "".join(f"<p>{t}</p>" for t in text)
            body += "".join(f"</{layer.split()[0]}>" for layer in reversed(layers))
            pages.append((f"http://s{site}.org/{n}", f"<html><body>{''.join(b.format(n) for b in before)}{body}{''.join(a.format(n) for a in after)}</body></html>"))
            expected.append("\n".join(text))
    found = texts_of(llm, pages)
    assert all(found)
    assert sum(a == b for a, b in zip(found, expected)) >= 0.95 * len(expected)
