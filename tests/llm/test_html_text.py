import html as entities
import re
import time

import pytest
from pyspark.sql import functions as F

from logilake.llm import html_text as ht

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<ul class="menu"><li><a href=#>Home</a><li><a>About</a></ul><div class="cookie-notice">We use cookies</div>
<div id="content"><h2>A title</h2><p>First para of text that is long enough &amp; good.<p>Short.
<div class="advert">Buy now!</div><p>Second <b>para</b>graph 1 &lt; 2.</p></div>
<div id="sidebar"><h3>Rel</h3><p>Some related thing here</p></div>
<section class="comments"><article class="comment"><p>I like it very much</p></article></section>
<form><label>Mail</label></form><footer>(c)</footer></body></html>"""


def test_page_without_article_element():
    assert ht.main_text(PAGE) == "A title First para of text that is long enough & good. Short. Second paragraph 1 < 2."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<nav>x<article><p>t</p></article>", "t"),
        ("<div><nav><a>1</a></div><p>para</p>", "para"),
        ("<p>a &amp b</p><!-- c --><p>d<br>e</p><p", "a & b d e"),
        ('<script>var t="</p>";</script><p>x</p>', "x"),
        ("<main><p>one</p><aside>ad</aside><p>two</p></main><p>outside, much longer than the article</p>", "one two"),
        ('<div class="content has-sidebar"><p>kept</p></div>', "kept"),
        ("a < b", "a < b"),
    ],
)
def test_small_pages(page, text):
    assert ht.main_text(page) == text


def test_parted_article_is_whole_and_far_lines_go():
    parts = [f"<p>{'word ' * 40}{i}</p>" for i in range(6)]
    page = "".join(parts[:3]) + '<div class="ad"><p>a</p><p>b</p><p>c</p><p>d</p></div>' + "".join(parts[3:])
    assert ht.main_text(page).split().count("word") == 240
    assert "tiny" not in ht.main_text("<p>tiny</p>" + "<p><a>l</a></p>" * 5 + page)


def test_articles_of_the_test_pages(spark, tiny):
    for row in ht.op10(spark, tiny).join(spark.read.parquet(f"{tiny}/pages.parquet"), ["page_id", "url"]).collect():
        body = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL).group(1)
        bare = re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", body))
        assert row.text == " ".join(entities.unescape(bare).split())
        assert row.n_chars == len(row.text)


def test_nulls_long_pages_and_clashing_columns(spark):
    rows = [(1, None, None), (None, "u", "<p>x</p>"), (3, "u", "<p>" + "long text " * 200_000 + "</p>"), (3, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit(2)})
    got = sorted((r.page_id or 0, r.n_chars) for r in ht.extract(pages).collect())
    assert got == [(0, 1), (1, 0), (3, 0), (3, 1_999_999)]
    assert ht.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("mark", ['class="overflow-hidden"', 'class="hidden-xs"', 'aria-hidden="false"', 'class="no-ads"', 'data-x="hidden"', 'class="page-wrapper"'])
def test_names_that_hide_nothing(mark):
    assert ht.main_text(f"<div {mark}><p>The whole text.</p></div>") == "The whole text."


@pytest.mark.parametrize(
    "mark",
    ["hidden", "HIDDEN=''", "class='a hidden'", "aria-hidden=true", 'style="color:red; display: none"', 'class="sidebar-left"', "id=page-footer"]
    + [f'class="{name}"' for name in ("nav-wrapper", "footer-container", "comments-wrapper", "ad-right")],
)
def test_names_of_boilerplate(mark):
    assert ht.main_text(f"<div {mark}><p>Not of the article at all.</p></div><p>The text.</p>") == "The text."


def test_body_outside_wins_over_marked_teaser_cards():
    body = [f"Sentence {i} of a long body that stands in a plain element, without any mark." for i in range(60)]
    cards = "".join(f'<article class="card"><h3>Card {i}</h3><p>Read more of it</p></article>' for i in range(4))
    page = "<div>" + "".join(f"<p>{t}</p>" for t in body) + f"</div><div>{cards}</div>"
    assert ht.main_text(page) == " ".join(body)
    # A marked article stays, though a shorter text that surges stands outside.
    assert ht.main_text("<main>" + "".join(f"<p>{t}</p>" for t in body) + "</main>" + f"<div><p>{body[0]}</p><p>{body[1]}</p></div>") == " ".join(body)


PROSE = "Some prose of the page that goes on. " * 16


@pytest.mark.parametrize(
    "wrapper",
    ["div class='elementor-widget-container'", "div class='wrapper sticky-header'", "div class='menu-open'", "div id='page-header-fixed'",
     "section class='search-results'", "div class='form-page'", "form id='aspnetForm'", "div class='cookie-page'"],
)
def test_wrappers_keep_their_prose(wrapper):
    name = wrapper.split()[0]
    page = f"<body><nav><a>Home</a></nav><{wrapper}><h1>Title</h1><p>{PROSE}</p><div class='comments'><p>I like it. {PROSE}{PROSE}</p></div></{name}></body>"
    assert ht.main_text(page) == f"Title {PROSE}".strip()
    if 'cookie' in wrapper:
        return  # believed until nothing else surges, so nothing inside stands for itself
    inside = f"<body><{wrapper}><ul>{'<li>A link of text</li>' * 40}</ul><main><p>{PROSE}</p></main></{name}><p>Text after it.</p></body>"
    assert ht.main_text(inside) == PROSE.strip()


def test_small_named_elements_still_go():
    page = f"<p>{PROSE}</p><div class='widget'><p>Widget words, forty characters of them.</p></div><form><p>Fill in this form, please, all of it.</p></form>"
    assert ht.main_text(page) == PROSE.strip()


@pytest.mark.parametrize("code", ["<script>var a = 1; <p>x</p>", "<style>p { color: red }", "<script src=x/>f()", "<SCRIPT>if (a < b) f()</scrip"])
def test_unclosed_code_runs_to_the_end(code):
    assert ht.main_text(f"<p>word word</p>{code}") == "word word"


def test_other_unclosed_raw_elements_end_with_their_parent():
    assert ht.main_text("<div><select><option>a</div><p>b</p>") == "b"


def test_pages_cut_anywhere_are_read_at_once():
    page = f"""<div data-x='{{"a": "b>c"}}' {" ".join(f'k{i}="v{i}"' for i in range(1000))}><p title="it's">{PROSE}</p></div>"""
    for whole in (page, PAGE, "<p>x</p>" + "<a " * 5000, '<p title="x ' * 5000, "<select>" * 5000, "<div>" * 5000 + "</b>" * 5000,
                  "<b>" + "<div>" * 5000 + "</b>" * 5000, "<div class=nav>" * 5000 + "x" + "</div>" * 5000):
        for cut in range(len(whole), 0, -max(1, len(whole) // 40)):
            begun = time.process_time()
            text = ht.main_text(whole[:cut])
            assert time.process_time() - begun < 1
            assert "k1=" not in text and "data-x" not in text
    assert ht.main_text("<p>text</p><div " + page) == "text " + PROSE.strip()


def test_every_part_of_the_test_pages(spark, tiny):
    for row in spark.read.parquet(f"{tiny}/pages.parquet").limit(20).collect():
        for cut in range(0, len(row.html), 97):
            begun = time.process_time()
            assert "function" not in ht.main_text(row.html[:cut])
            assert time.process_time() - begun < 0.5


def test_empty_table(spark, write_tables):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert ht.op10(spark, write_tables(pages=empty)).collect() == []
