"""HTML extraction: articles out of whole pages, and branches that repeat over a site."""

import html
import re

from tripweave.llm import html_text, queries
from tripweave.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def text_of(page: str) -> str:
    return html_text.main_text(page, frozenset())


def test_given_pages(spark):
    pages = table(spark, SF_DIR, "pages")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op4_html_extraction(spark, SF_DIR).collect()}
    assert len(got) == pages.count()
    for row in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        article = re.sub(r"<(?!/?b\b)[^>]*>", " ", article)
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", "", article)).split())
        assert got[row.page_id] == (row.url, text, len(text))


def test_what_calls_itself_noise_goes():
    noise = [
        "<nav>x</nav>", "<header>x</header>", "<footer>x</footer>", "<aside>x</aside>", "<form>x</form>",
        "<script>if (a < b) { '</p>' }</script>", "<style>p { }</style>", "<!-- x -->", "<noscript>x</noscript>",
        '<div class="ad">x</div>', '<div id="cookie-notice">x</div>', "<div role=navigation>x</div>",
        '<section class="user-comments">x</section>', '<ul class="SideBar menuItems">x</ul>',
        '<div hidden>x</div>', '<div class="page-header">x</div>', "<textarea><p>x</textarea>",
    ]
    for part in noise:
        assert text_of(f"<html><body>{part}<p>one<p>two</p>{part}</body></html>") == "one two"
    inside = "<article><header><h1>Title</h1></header><p>one</p><footer>x</footer><div class=share>x</div></article>"
    assert text_of(inside) == "Title one"
    assert text_of(f"<p>outside</p>{inside}<p>after</p>") == "Title one"
    assert text_of('<div class="addendum radio">kept</div>') == "kept"
    assert text_of('<body class="sidebar"><div class="page has-sidebar no-comments"><p>kept</div>') == "kept"
    assert text_of(f"<main><p>around</p>{inside}</main>") == "Title one"
    assert text_of("<main><p>main part</p><nav>x</nav></main><p>rest</p>") == "main part"


def test_text_of_blocks_and_broken_markup():
    assert text_of("<p>a<b>b</b> c&amp;lt; &eacute;&#233;\n\t d<br>e</p><p>f") == "ab c&lt; éé d e f"
    assert text_of("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a b c d e"
    assert text_of("<article><p><b>a<br><p>b</p></article><footer>x") == "a b"
    assert text_of("a < b and 3<4 </nope> <p class='>'>c") == "a < b and 3<4 c"
    assert text_of("<p title=\"open>text") == "text" or text_of("<p title=\"open>text") == ""
    for page in ("", "<", "<!--", "<a href='", "</p></p>", "<script>", "\0", "<p" * 1000, "<div>" * 3000 + "x"):
        text_of(page)
        html_text.branches(page)


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'t' as text", "1 as host", "2 as path", "3 as page"
    )


def test_branches_that_repeat_over_a_site_go(spark, monkeypatch):
    def page(k):
        teaser = "<div class='box'><p>Read our other stories today</p></div>"
        return f"<body>{teaser}<div class='body'><p>Story {k} tells of {k * k}</p></div></body>"

    rows = [(k, f"http://Site.example:80/{k}", page(k)) for k in range(6)]
    rows += [(10 + k, f"http://small.example/{k}", page(k)) for k in range(2)]
    rows += [(20, None, page(0)), (21, "no host", page(1)), (22, None, page(0)), (23, None, page(0))]
    expected = {k: f"Story {k} tells of {k * k}" for k in range(6)}
    expected |= {10 + k: f"Read our other stories today Story {k} tells of {k * k}" for k in range(2)}
    expected |= {k: f"Read our other stories today Story {n} tells of {n}" for k, n in ((20, 0), (21, 1), (22, 0), (23, 0))}
    for limit in (html_text.BROADCAST_BRANCHES, 0):  # 0: noise branches are joined, not broadcast
        monkeypatch.setattr(html_text, "BROADCAST_BRANCHES", limit)
        got = {r.page_id: r.text for r in html_text.extract_text(pages_of(spark, rows)).collect()}
        assert got == expected


def test_an_article_that_pages_repeat_stays(spark):
    rows = [(k, f"http://a.example/{k}", "<body><article><p>The same</p></article></body>") for k in range(8)]
    assert {r.text for r in html_text.extract_text(pages_of(spark, rows)).collect()} == {"The same"}


def test_nulls_long_pages_repeats_and_no_rows(spark):
    long = "<p>" + "word &amp; " * 50_000
    rows = [(1, "http://a.example/", None), (2, None, ""), (None, "http://a.example/", "<p>x"), (3, "u", long), (3, "u", long)]
    got = sorted(((r.page_id, r.url, r.n_chars) for r in html_text.extract_text(pages_of(spark, rows)).collect()), key=str)
    size = len("word & " * 50_000) - 1
    assert got == sorted(
        [(1, "http://a.example/", 0), (2, None, 0), (None, "http://a.example/", 1), (3, "u", size), (3, "u", size)], key=str
    )
    assert html_text.extract_text(pages_of(spark, [])).collect() == []


def test_boilerplate_inside_articles_goes_and_their_text_stays(spark):
    def page(k, tag):
        box = "<div class='box'><h3>Read next</h3><p>Ten letters we liked</p></div>"
        return (
            f"<body><{tag}><h1>Story {k}</h1><h2>Facts</h2><p><b>Note</b> {k * k}</p>{box}"
            f"<p class='line'>Some rights kept</p></{tag}></body>"
        )

    rows = [(k, f"http://a.example/{k}", page(k, "article")) for k in range(6)]
    rows += [(10 + k, f"http://m.example/{k}", page(k, "main")) for k in range(6)]
    # Copies of one page are one page, so they outvote nothing.
    copies = "<body><article><h1>Long</h1><p>The same</p></article></body>"
    rows += [(20 + k, f"http://c.example/{k}", copies) for k in range(9)]
    rows += [(30, "http://c.example/x", copies.replace("same", "other"))]
    got = {r.page_id: r.text for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    for k in range(6):
        assert got[k] == got[10 + k] == f"Story {k} Facts Note {k * k}"
    assert {got[20 + k] for k in range(9)} == {"Long The same"} and got[30] == "Long The other"


def test_articles_main_part_and_rest_are_weighed():
    body = "The body of this page is much longer than all that is told of other pages. " * 3
    body = body.strip()
    cards = "<article class='card'><p>One</p></article><article><a href='/2'><p>Two</p></a></article>"
    assert text_of(f"<main><p>{body}</p>{cards}</main>") == body
    assert text_of(f"<div><p>{body}</p></div>{cards}") == body
    assert text_of(f"{cards}<main><p>{body}</p></main><p>rest</p>") == body
    assert text_of(f"<main><p>short</p></main><div>{body}</div>") == f"short {body}"
    # In doubt nothing goes: an article that is no card, and articles that are the larger part.
    assert text_of(f"<main><p>{body}</p><article>Own</article></main>") == f"{body} Own"
    many = "".join(f"<article class='card'>{k} {'x' * 60}</article>" for k in range(9))
    assert text_of(f"<main><p>{body}</p>{many}</main>").startswith(body + " 0 x")
    # A title and a lead before the article, but nothing behind it.
    page = f"<main><div><h1>Title</h1><p>Lead</p></div><article><p>{body}</p></article><h2>More</h2><p>x</p></main>"
    assert text_of(page) == f"Title Lead {body}"
    assert text_of(f"<ul><li><a>{'menu ' * 200}</a></ul><article>{body}</article>") == body


def test_counts_decide_which_part_weighs_more(spark):
    about = "<main><p>What this site is about is told on all of its pages, at great length</p></main>"
    rows = [(k, f"http://a.example/{k}", f"{about}<article>No {k} is {k * k}</article>") for k in range(6)]
    got = {r.page_id: r.text for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    assert got == {k: f"No {k} is {k * k}" for k in range(6)}


def test_doubtful_names_in_articles_need_counts(spark):
    kept = [
        "<section id='discussion'>%s</section>", "<h2 id='related-work'>%s</h2>", "<div class='social-science'>%s</div>",
        "<div class='legal'>%s</div>", "<p class='notice'>%s</p>", "<div id='search'>%s</div>", "<h2 id='comments'>%s</h2>",
        "<div class='entry-header'>%s</div>", "<pre><span class='hljs-comment'>%s</span></pre>", "<div class='market-share'>%s</div>",
    ]
    for part in kept:
        assert text_of(f"<article><p>one</p>{part % 'two'}</article>") == "one two"
        assert text_of(f"<main><p>one</p>{part % 'two'}</main>") == "one two"
    assert text_of("<article id='legal-news'><p>one</p></article>") == "one"
    for part in ("<div class='share-buttons'>", "<div class='newsletter'>", "<div class='post-comments'>", "<div role=search>"):
        assert text_of(f"<article><p>one</p>{part}x</div></article>") == "one"
        assert text_of(f"<article><p>one</p>{part}x</div><header class=ad>x</header></article>") == "one"

    def page(k):
        # Three of the eight pages have the notice of their own: between the two limits.
        notice = f"Only here {k}" if k < 3 else "Read the rules"
        return (
            f"<article><h2 id='related-work'>Related work</h2><div class='discussion'>Talk {k}</div>"
            f"<div class='notice'>{notice}</div><div class='plain'>{notice}</div><span class='legal'>All rights</span></article>"
        )

    rows = [(k, f"http://a.example/{k}", page(k)) for k in range(8)]
    got = {r.page_id: r.text for r in html_text.extract_text(pages_of(spark, rows)).collect()}
    for k in range(8):
        notice = f"Only here {k}" if k < 3 else "Read the rules"
        assert got[k] == f"Related work Talk {k} {notice}"
