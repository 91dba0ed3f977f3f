import re
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_text

LONG = "A sentence, with some punctuation, that goes on. And another one follows here; it ends."


def test_given_pages_give_their_article(table):
    for r in html_text.with_main_text(table("pages"), ["page_id", "url", "html"]).collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b) for b in re.split(r"</?(?:p|h1)>", article)]
        want = [" ".join(unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(b for b in want if b) and r.n_chars == len(r.text)


PAGE = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h2>Site</h2><p>{LONG}</p></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice"><p>{LONG} {LONG}</p></div>
<div id=wrap><div class="content"><h1>Head&nbsp;line</h1><p>First <b>bold</b>,\n and&amp;so <i>on</i>. {LONG}</p>
<p>Short.</p><script>if (a < b) {{ "</p>" }}</script><ul><li>one<li>two</ul><blockquote>Quoted, yes.</blockquote>
<pre>a   b</pre><p hidden>{LONG}</p><form><p>Your name, please: {LONG}</p></form><p>{LONG}</p></div>
<aside><p>{LONG}</p></aside><div class="sidebar"><p>{LONG}</p></div><div class="ad"><p>Buy, now. {LONG}</p></div>
<section id="comments"><p>I agree, fully. {LONG}</p></section></div><footer><p>{LONG}</p></footer></body></html>"""


def test_boxes_beside_the_article_go():
    want = ["Head line", f"First bold, and&so on. {LONG}", "Short.", "one", "two", "Quoted, yes.", "a b", LONG]
    assert html_text.main_text(PAGE).split("\n") == want


@pytest.mark.parametrize("html", [None, "", " ", "<!--", "<script>x", "<nav>a</nav>", "<p", "</p></div>"])
def test_no_article(html):
    assert html_text.main_text(html) == ""


def test_broken_and_bare_pages():
    assert html_text.main_text("<") == "<"
    assert html_text.main_text("just text &lt;b&gt; &#x41;&copy") == "just text <b> A©"
    assert html_text.main_text(f"<body><article><p>{LONG}<p>End of <em>it") == f"{LONG}\nEnd of it"
    assert html_text.main_text(f"<div class=menu>a, b.</div><p>{LONG}</p><p>Tiny</p>") == f"{LONG}\nTiny"
    deep = "<div>" * 3000 + f"<p>{LONG}</p>"
    assert html_text.main_text(deep) == LONG


def test_path_scores_rise_with_length_and_punctuation():
    found = html_text.leaves(f"<div><p>{LONG}</p><p>{LONG}</p></div><ul>" + "<li>x</li>" * 9 + "</ul>")
    score = html_text.path_scores(found)
    assert score[0] > 20 * score[-1]


def test_odd_rows(spark):
    long = "<article>" + f"<p>{LONG}</p>" * 40_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>hi</p>"), (3, "w", long), (3, "w", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"text": F.lit("mine"), "n_chars": F.lit(1)})
    got = html_text.with_main_text(df, ["page_id", "url", "text"]).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [
        (0, 2), (1, 0), (2, 0), *[(3, 40_000 * (len(LONG) + 1) - 1)] * 2]
    assert html_text.with_main_text(df.where("false")).count() == 0


@pytest.mark.parametrize("script", [
    "<script>if (a<b) x(); // don't</script>", "<script><!-- var a = 1;</script>", "<style>a<b 'c</style>",
    "<textarea>x <y \"z</textarea>",
])
def test_tokens_do_not_run_out_of_raw_elements(script):
    html = f"{script}<nav>menu, menu.</nav><article><p>One</p><p>It's {LONG}</p></article><footer>{LONG} It's</footer>"
    assert html_text.main_text(html) == f"One\nIt's {LONG}"


@pytest.mark.parametrize("tag", ["div class=part", "article", "section"])
def test_content_in_a_second_box_stays(tag):
    first, second = [f"{i} {LONG}" for i in range(13)], [f"{i} {LONG}" for i in range(13, 20)]
    box = lambda ps: f"<{tag}><h2>Part</h2>" + "".join(f"<p>{p}</p>" for p in ps) + f"<ul><li>x</ul><p>{LONG}</p></{tag.split()[0]}>"
    html = f"<body><div id=page><ul><li>Home<li>Contact</ul>{box(first)}{box(second)}<table><tr><td>a<td>b</table></div></body>"
    want = ["Part", *first, "x", LONG, "Part", *second, "x", LONG]
    assert html_text.main_text(html).split("\n") == want


@pytest.mark.parametrize("name", [
    "class='content-sidebar-wrap'", "class=sidebar-right", "class='layout-sidebar-right'", "class=main-nav-offset",
    "id=social-impact", "class=header",
])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_the_name_of_a_wrapper_does_not_veto_the_article(name, inner):
    text = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p><p>Short.</p>"
    beside = f"<div class=sidebar><p>{LONG}</p></div>"
    html = f"<body>{beside}<div {name}><{inner}>{text}</{inner}><div class='ad'><p>{LONG}</p></div></div></body>"
    assert html_text.main_text(html).split("\n") == ["Head", LONG, LONG, "Short."]


def test_named_boxes_with_articles_of_their_own_stay_beside():
    teasers = "".join(f"<article><p>{LONG}</p></article>" for _ in range(2))
    html = f"<article><p>{LONG}</p><p>{LONG} {LONG}</p></article><div class=related-posts>{teasers}</div>"
    assert html_text.main_text(html) == f"{LONG}\n{LONG} {LONG}"


@pytest.mark.parametrize("page", [
    "<a " * 400_000, "<a \"x' " * 60_000, "<a " * 100_000 + '">', "<script>" + "</script " * 100_000,
    "<div class='" + "a_" * 200_000 + "'>", "<a ' <b \" " * 50_000,
])
def test_tags_that_never_end_take_a_few_passes(page):
    start = time.process_time()
    html_text.main_text(page)
    html_text.main_text("<article><p>One, two, three, four. Five, six.</p></article>" + page)
    assert time.process_time() - start < 6


def test_what_follows_a_broken_tag_is_still_read():
    page = "<div>a < b, said <i \"x <b>they</b>.</div><article><p>A text, with stops, and words.</p></article>"
    assert "A text, with stops, and words." in html_text.main_text(page)
    assert html_text.Tags('<a "><b>').next(0)[3] == "b"
