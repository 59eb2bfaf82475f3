import html
import re
import time

import pytest

from glotta.llm import html_density as hd

LONG = "A sentence of the article that says something, at some length, without a link. " * 4


def article(page):
    """The blocks of the article element, read off the generated markup."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", inner))
    texts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in blocks)
    return "\n\n".join(t for t in texts if t)


@pytest.mark.parametrize("page, want", [
    ("", ""), (" \n ", ""), ("just text < 5 &amp; more", "just text < 5 & more"), ("<p>a<div>b</p>c</div>", "a\n\nbc"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\n\nc"), ("<!-- x --><!doctype html><p>a<!-- unclosed", "a"),
    ("<script>var t='</p>';</script><style>p{}</style><p>&eacute;&#233;&#xe9;&nbsp;x</p>", "ééé x"),
    ("<p>a<script>never closed", "a"), ("<p title='>'>a</p><p data-x=\"</p>\">b</p>", "a\n\nb"),
])
def test_odd_markup(page, want):
    assert hd.main_text(page) == want


@pytest.mark.parametrize("noise", [
    '<nav><a href="x">Home</a></nav>', '<div id="top-menu"><a href="x">Home</a> <a href="y">News</a></div>',
    "<header><p>The paper of record</p></header>", "<footer>&copy; someone</footer>",
    f'<div class="sidebar"><p>{LONG}</p></div>', f'<aside>{LONG}</aside>', '<div class="ad">Buy this now</div>',
    '<div class="cookie-notice">We use cookies</div>', "<form>Name <input> <button>Send</button></form>",
    f'<section id="comments"><p>{LONG * 5}</p></section>', '<ul class="social"><li><a href="x">Share</a></li></ul>',
    '<div role="navigation"><a href="x">Up</a></div>', '<ul><li><a href="a">One</a></li><li><a href="b">Two</a></li></ul>',
])
@pytest.mark.parametrize("shell", ["<article>%s</article>", '<div class="text">%s</div>'])
def test_noise_is_left_out(noise, shell):
    text = f"<h1>The title</h1><p>{LONG}<p>Short one.<p>With a <a href='l'>link</a> in it. {LONG}"
    page = f"<html><head><title>t</title></head><body>{noise}{shell % text}{noise}</body></html>"
    want = "\n\n".join(x.strip() for x in ("The title", LONG, "Short one.", f"With a link in it. {LONG}"))
    assert hd.main_text(page) == want


def test_density_of_a_node():
    page = hd.Page("<body><div><p>" + "x" * 100 + "</p></div><ul><li><a>" + "y" * 50 + "</a></li></ul></body>")
    density, total, chars, links = hd.densities(page)
    by_name = {n: i for i, n in enumerate(page.name)}
    assert chars[by_name["body"]] == 150 and links[by_name["body"]] == 50
    assert density[by_name["p"]] > 5 * density[by_name["li"]]
    assert total[by_name["div"]] == pytest.approx(density[by_name["p"]])


def test_very_long_and_deep_pages():
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    assert hd.main_text(deep) == LONG.strip()
    assert len(hd.main_text("<p>" + "word " * 200_000)) == 999_999
    assert hd.main_text("<" * 20_000 + "a") == "<" * 20_000 + "a"


def test_odd_rows(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", 1), (1, "u", f"<p>{LONG}</p>", 1), (None, None, None, None), (2, None, "", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, hd.extract(df).collect()), key=str)
    text = LONG.strip()
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=str)
    assert hd.extract(df.limit(0)).count() == 0


def test_query_equals_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = hd.op5_composite_text_density(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article(pages[r.page_id].html), len(r.text))


def paragraphs(n, size):
    return "".join(f"<p>{('text ' * size)[:size - 1]}.</p>" for _ in range(n))


SECTIONED = f"<h1>A title of 20 chars.</h1><section>{paragraphs(5, 300)}</section><section>{paragraphs(3, 60)}</section>"


@pytest.mark.parametrize("page, blocks", [
    (f"<body><article>{SECTIONED}</article></body>", 9), (f"<body><main><div>{SECTIONED}</div></main></body>", 9),
    (f"<body><div>{SECTIONED}</div></body>", 9), (f"<body>{SECTIONED}</body>", 9),
    (f"<body><div><h1>The title</h1><div>{paragraphs(5, 300)}</div></div></body>", 6),
    (f"<body><h1>The title</h1><div>{paragraphs(5, 300)}</div></body>", 6),
    (f"<body><article>{paragraphs(5, 300)}<ul><li><a href='x'>A source</a></li></ul></article></body>", 6),
    (f"<body><div>{paragraphs(5, 300)}</div><ul><li><a href='x'>A menu</a></li></ul></body>", 5),
])
def test_articles_in_parts_are_whole(page, blocks):
    assert len(hd.main_text(page).split("\n\n")) == blocks


@pytest.mark.parametrize("open_, close", [
    ('<div style="overflow:hidden">', "</div>"), ('<div aria-hidden="false">', "</div>"),
    ('<div data-title="the id=menu">', "</div>"), ('<div class="site no-sidebar">', "</div>"),
    ('<div class="post" id="promotion-of-peace">', "</div>"), ("<div data-x='role=\"menu\" hidden'>", "</div>"),
    ('<body class="menu">', "</body>"), ('<div id="comments-on-the-war"><article>', "</article></div>"),
])
def test_attributes_alone_lose_no_article(open_, close):
    page = f"<nav><a href='x'>Home</a></nav>{open_}<h1>The title</h1>{paragraphs(4, 300)}{close}<footer>someone</footer>"
    assert len(hd.main_text(page).split("\n\n")) == 5


@pytest.mark.parametrize("noise", ["<div hidden>%s</div>", "<div HIDDEN=''>%s</div>", "<div role=dialog>%s</div>",
                                   "<div class='big comments'>%s</div>", "<div id=cookie_notice>%s</div>"])
def test_marked_parts_go(noise):
    body = f"<div><h1>The title</h1>{paragraphs(4, 300)}</div>"
    assert len(hd.main_text(body + noise % paragraphs(2, 300)).split("\n\n")) == 5


def test_longer_comments_than_article_go():
    page = f"<div><h1>The title</h1>{paragraphs(4, 300)}</div><div id='comments'>{paragraphs(14, 300)}</div>"
    assert len(hd.main_text(page).split("\n\n")) == 5


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + LONG + "</i>" * 100_000, "<ul>" * 100_000 + LONG, "<a " * 100_000, "<a" * 100_000, "<a \"" * 100_001,
    "<a \"" * 100_000 + "'>", "<a '\" " * 100_000 + "x", "</p>" * 100_000 + LONG, "<p " + "a='1' " * 100_000 + f">{LONG}</p>",
    "<div class=menu>" * 50_000 + LONG,
], ids=range(10))
def test_odd_markup_takes_linear_time(page):
    started = time.process_time()
    text = hd.main_text(page)
    assert time.process_time() - started < 10
    assert LONG not in page or text == LONG.strip()
