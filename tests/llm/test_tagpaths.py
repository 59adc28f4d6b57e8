from __future__ import annotations

import html
import re
import time

import pytest

from possum.llm.queries import QUERIES
from possum.llm.tagpaths import extract, main_text


def article(page):
    """The article's blocks by a plain pattern; holds for the synthetic pages."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in blocks)
    return "\n".join(t for t in texts if t)


def test_every_page_of_the_table(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op2_tag_path_ratios"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.text, r.n_chars) == (article(pages[r.page_id]), len(r.text))


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"), ("x<b>y</b>  z<p>w", "xy z\nw"),
    ("<script>alert('<p>no</p>')", ""), ("<!-- <p>no</p>", ""), ("<p>1 &lt; 2 &amp 3 &#x41;</p>", "1 < 2 & 3 A"),
    ("<p>a < b > c</p>", "a < b > c"), ('<p title="x>y">q</p>', "q"), ("<title>no</title><p>yes", "yes"),
    ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<table><tr><td>a<td>b</table>", "a\nb")])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_boilerplate_goes_and_the_article_stays():
    body = "".join(f"<p>Paragraph {k}, with words, commas, and a <a href='#'>link</a> inside it.</p>" for k in range(4))
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>
      <nav><ul><li><a href=/>Home</a></ul></nav><div id="cookie-notice"><p>We use cookies, please agree, or leave.</p></div>
      <div class="with-sidebar"><article><header><h1>Title</h1><span>by someone</span></header>{body}
      <form><p>Your mail, please.</p><input></form><section class="comments"><p>First, as a reader, I object.</p></section></article>
      <aside><p>Read, also, this long list, of other things, on the site.</p></aside></div>
      <div class="adBox"><p>Buy now, buy here, buy this.</p></div><footer><p>Imprint, terms, and so on.</p></footer></body></html>"""
    want = ["Title", *(f"Paragraph {k}, with words, commas, and a link inside it." for k in range(4))]
    assert main_text(page) == "\n".join(want)


@pytest.mark.parametrize("inline", [
    "<button>Play</button>", "<math>x</math>", "<svg><text>x</text></svg>", '<a class="social-handle">@x</a>',
    '<span class="alert">Note</span>', '<span role="alert">Note</span>', "<span hidden>Note</span>"])
def test_an_inline_element_goes_and_its_paragraph_stays(inline):
    more = "<p>Another paragraph, with some words, and more of them.</p>"
    for page, text in ((f"<p>{inline} long text, and so on.</p>", "long text, and so on."),
                       (f"<p>A long text, {inline} and so on.</p>", "A long text, and so on.")):
        assert main_text(f"<article>{page}{more}</article>") == text + "\nAnother paragraph, with some words, and more of them."


PROSE = "A paragraph of the article, with commas, and as many words as prose has, one after another, and more. " * 2


@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_article_is_kept_whole(tag):
    """A linked headline, a list of sources, a data table and a small box beside prose; links outside go."""
    rows = [["Year", "Sold", "Lost"], ["2001", "7", "12"], ["2002", "9", "3"]]
    table = "".join("<tr>" + "".join(f"<{c}>{x}</{c}>" for x in r) + "</tr>" for c, r in zip(("th", "td", "td"), rows, strict=True))
    page = (f"<body><{tag}><h1><a href=/a>Title</a></h1><p>{PROSE}</p><p>{PROSE}</p><table>{table}</table><p>{PROSE}</p>"
            f"<div>7 km</div><ul><li><a href=/1>One source</a></li><li><a href=/2>Two</a></li></ul></{tag}>"
            "<div><ul><li><a href=/x>Elsewhere</a></li></ul></div></body>")
    prose = PROSE.strip()
    assert main_text(page).split("\n") == ["Title", prose, prose, *(x for r in rows for x in r), prose, "7 km", "One source", "Two"]


def test_a_long_page_and_deep_nesting():
    long = "<article>" + "<p>word, " * 20_000 + "</article>"
    assert main_text(long) == "\n".join(["word,"] * 20_000)
    assert main_text("<div>" * 2_000 + "deep" + "</div>" * 2_000) == "deep"


def test_rows_and_clashing_columns(spark):
    rows = [(1, None, "a"), (1, "<p>x</p>", "b"), (1, "<p>x</p>", "b"), (None, "", "c")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text_ string")
    got = [tuple(r) for r in extract(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, "", "a"), (1, "x", "b"), (1, "x", "b"), (None, "", "c")], key=str)
    assert extract(pages.limit(0)).collect() == []
    same = pages.withColumnRenamed("text_", "text")
    assert extract(same).columns == ["page_id", "text"]


@pytest.mark.parametrize("tail", ["<a " + 'x="y" ' * 200_000, "<" * 1_000_000, "<a x=\"" * 150_000, "<a x=\">\" " * 120_000,
                                  "<div>w" * 150_000, "<a<b" * 250_000 + ">", "<p>" + "</x>" * 250_000, "x='<a " * 150_000 + ">"])
def test_a_cut_off_or_broken_page_takes_linear_time(tail):
    start = time.perf_counter()
    text = main_text(f"<article><p>{PROSE}</p>" + tail)
    assert PROSE.strip() in text and time.perf_counter() - start < 10


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize("box", [
    f'<div class="author-bio"><p>{PROSE}</p></div>', f'<section class="discussion"><p>{PROSE}</p></section>',
    f'<div class="reader-feedback"><p>{PROSE}</p></div>', f'<div id="comment-12"><p>{PROSE}</p></div>',
    '<ul class="post-tags"><li><a href=/t>History</a><li><a href=/u>Spain</a></ul>', '<p class="byline">By Jane Doe</p>',
    '<div class="related-reading"><a href=/1>One more</a> <a href=/2>And another one</a></div>'])
def test_named_boxes_go_inside_articles_too(tag, box):
    page = f"<body><{tag}><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p>{box}<p>{PROSE}</p></{tag}></body>"
    assert main_text(page).split("\n") == ["Title", *[PROSE.strip()] * 3]


@pytest.mark.parametrize("tag", ["article", "div"])
def test_one_word_of_a_class_name_does_not_outvote_prose(tag):
    page = (f'<body><{tag}><h1>Title</h1><p>{PROSE}</p><div class="related-work"><p>{PROSE}</p></div><p class="legal-history">{PROSE}</p>'
            f'<p>The <span class="search-term">price</span> fell, and {PROSE}</p></{tag}></body>')
    assert main_text(page).split("\n") == ["Title", *[PROSE.strip()] * 3, "The price fell, and " + PROSE.strip()]
