import time

import numpy as np
import pytest

from textpulse.llm import page_text as pages

PAGE = """<!DOCTYPE html><html><head><title>Site &amp; page</title><style>p{}</style>
<script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu one</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this now.</div><article><h1>A  title</h1><p><b>First &lt;words&gt;
of it<br>and more<p>Second &eacute; block, <i>in</i>line.<div class="comments"><p>Nice one!</p></div>
<form>Your <input name=q> name</form></article><footer>&copy; site &middot; words</footer></body>"""
TEXT = "A title First <words> of it and more Second é block, inline."


@pytest.fixture(scope="module")
def scores():
    return pages.learn_scores([PAGE, PAGE.replace("Menu", "Other")] * 20 + [None, ""])


def test_article_text(scores):
    assert pages.main_text(PAGE, scores) == TEXT
    assert pages.main_text(PAGE.replace("article>", "section>"), scores) == TEXT


@pytest.mark.parametrize("extra, text", [
    ("<ul>" + "<li><a href='/y'>Item</a></li>" * 10 + "</ul>", " Item" * 10),
    ("<ol><li>one<li>two</ol>", " one two"),
    ("<table><tr><td>one<td>two<tr><td>3<td>4</table>", " one two 3 4"),
    ("<p><a href='/z'>Linked words</a></p>", " Linked words"),
    ("<div class='ad'><ul>" + "<li><a href='/b'>Buy</a> now</li>" * 20 + "</ul></div>", ""),
    ("<form><select>" + "<option>choice of many words here" * 20 + "</select></form>", ""),
])
@pytest.mark.parametrize("last", ["", "<p>Last words."])
def test_links_lists_tables_and_adverts_in_articles(scores, extra, text, last):
    page = PAGE.replace("</article>", extra + last + "</article>")
    assert pages.main_text(page, scores) == TEXT + text + (" Last words." if last else "")


@pytest.mark.parametrize("old, new", [
    ("<body>", '<body class="has-sidebar">'),
    ("<body>", '<body id=menu class="widget">'),
    ("<article>", '<article class="post comments-open">'),
    ("<article>", '<article class="comments">'),
    ("<article>", '<div class="content with-sidebar"><article>'),
    ("<article>", '<div class="share"><div id="main-share-wrapper"><article>'),
    ("<article>", '<div class="widget"><main id="menu"><article>'),
])
@pytest.mark.parametrize("marked", [True, False])
def test_names_around_the_content(scores, old, new, marked):
    page = PAGE.replace(old, new)
    if not marked and "share" not in new and "widget" not in new and "comments" not in new:
        page = page.replace("article", "section")
    assert pages.main_text(page, scores) == TEXT


def test_comments_that_are_articles_stay_out(scores):
    more = '<div class="comments"><article><p>I disagree with all of it.</p></article></div>'
    assert pages.main_text(PAGE.replace("</article>", "</article>" + more), scores) == TEXT


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<div><br></div>", "<!-- only -->", "<"])
def test_little_or_broken_pages(scores, page):
    assert pages.main_text(page, scores) in ("", "<")


def test_long_and_cut_pages(scores):
    body = "<article><h1>T</h1>" + "<p>some words here" * 5000
    assert pages.main_text(body + "<p cla", scores) == "T" + " some words here" * 5000


def test_without_labelled_pages():
    plain = pages.Scores()
    assert pages.learn_scores([]) == plain
    page = "<ul><li>a<li>b</ul><p>many words of running text that go on</p><ul><li>c<li>d</ul>"
    assert pages.main_text(page, plain) == "many words of running text that go on"


def test_best_region_equals_all_regions():
    random = np.random.default_rng(8)
    for _ in range(300):
        values = random.integers(-3, 4, random.integers(1, 12)).astype(float)
        begin, end = pages.best_region(values)
        best = max(
            (values[i:j].sum(), j - i, -i)
            for i in range(len(values))
            for j in range(i, len(values) + 1)
        )
        if best[0] <= 0:
            assert (begin, end) == (0, 0)
        else:
            assert (values[begin:end].sum(), end - begin, -begin) == best


def test_table(spark):
    rows = [(n, "u", PAGE) for n in range(100, 140)]
    rows += [(1, "u1", PAGE), (1, "u1", PAGE), (2, None, None), (None, "u3", ""), (9007199254740993, "u", PAGE)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table = table.selectExpr("*", "'x' as text", "1 as n_chars", "2 as `a.b`", "3 as _html")
    found = pages.extract(table, pages.train(table)).collect()
    assert sorted((str(r.page_id), str(r.url), r.text) for r in found) == sorted(
        (str(i), str(u), TEXT if p == PAGE else "") for i, u, p in rows
    )
    assert all(r.n_chars == len(r.text) for r in found)
    empty = table.limit(0)
    assert pages.extract(empty, pages.train(empty)).count() == 0


@pytest.mark.parametrize("inside, text", [
    ('<p><a title="a > b" href=x>Quoted words</a></p>', " Quoted words"),
    ("<p data-id='header' data-class=ad>Kept words</p>", " Kept words"),
    ('<p title="class=ad id=menu">Kept too</p>', " Kept too"),
    ("<p it's fine>Odd quote</p><p>it's fine</p>", " Odd quote it's fine"),
    ('<p class="entry-header">Its heading</p>', " Its heading"),
])
def test_attributes_are_read_as_such(scores, inside, text):
    assert pages.main_text(PAGE.replace("</article>", inside + "</article>"), scores) == TEXT + text


@pytest.mark.parametrize("name", [
    'class="comment-list"', 'id="comments-area"', 'class="left-sidebar"', 'id="cookie-bar"',
    "class=siteFooter", "id='page_header'", 'class="box ad-slot"', "class=relatedPosts",
])
@pytest.mark.parametrize("marked", [True, False])
def test_parts_named_by_longer_names_stay_out(scores, name, marked):
    noise = f"<div {name}><p>Words of no content at all.</p></div>"
    for place in ("</article>", "</article>" + noise):
        page = PAGE.replace("</article>", noise + place if place == "</article>" else place)
        if not marked:
            page = page.replace("article", "section")
        assert pages.main_text(page, scores) == TEXT


def test_a_wrapper_of_everything_is_no_noise(scores):
    page = PAGE.replace("article", "section").replace("<section>", '<div id="nav-wrap"><section>')
    assert pages.main_text(page, scores) == TEXT
    long = "<p>" + "What readers say about it. " * 100
    page = PAGE.replace("</article>", f'</article><div class="comment-list">{long}</div>')
    assert pages.main_text(page, scores) == TEXT
    assert pages.main_text(page.replace("article", "section"), scores) == TEXT


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "</b>" * 100_000,
    "<b>" * 100_000 + "<p>x" * 50_000,
    "<div class=ad><article>" * 50_000,
    "<p title='" * 100_000,
    '<p title="a' * 100_000,
    "<" * 200_000,
])
def test_time_grows_with_the_page(scores, page):
    begin = time.perf_counter()
    pages.main_text(page, scores)
    assert time.perf_counter() - begin < 10
