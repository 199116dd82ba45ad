from __future__ import annotations

import html
import re

import pytest

from mercato.llm import html_text


def text_of(page):
    return html_text.main_texts([page], html_text.train())[0]


def test_every_page_equals_its_article(spark):
    """The given pages hold one article of headings and paragraphs."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>T</title><body><p>Hello world, this is a text of some length.<p>More &amp; more&nbsp;text", "Hello world, this is a text of some length.\nMore & more text"),
        ("<nav><a href=x>A</a></nav><article><h1>T</h1><p>Short.</p><div class='ad'>Buy now the best shoes in town.</div><p>One</p></article>", "T\nShort.\nOne"),
        ("<div class='notice'>Please log in.</div><main><p>The story <b>goes</b>on.</p></main><section id='comments'><p>I like this article a lot, thank you.</p></section>", "The story goeson."),
        ("<article><p>a &lt;tag&gt; &#233;</p><script>var t='</p>';</script><!-- <p>no</p> --><form><p>Your mail</p><button>Go</button></form></article>", "a <tag> é"),
        ("<aside><p>Most read stories of the week are listed here.</p></aside><article>plain text</article>", "plain text"),
        ("<script>x", ""),
        ("<article><p>unclosed <!-- rest", "unclosed"),
        ("", ""),
    ],
)
def test_pages(page, want):
    assert text_of(page) == want


STORY = "<h1>Title</h1><p>The story of the old bridge, which the town wants to keep.</p><p>It was short.</p>"
TOLD = "Title\nThe story of the old bridge, which the town wants to keep.\nIt was short."


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='layout has-sidebar'><article>{STORY}</article></div>",
        f"<main class='no-sidebar'>{STORY}</main>",
        f"<article class='post tags-news'>{STORY}</article>",
        f"<div id='content' class='with-header'>{STORY}</div>",
        f"<div class='post-content no-comments'>{STORY}</div>",
        f"<div class='page sidebar-left'><nav><a href=x>Home</a></nav><div class='content'>{STORY}</div><div class='sidebar'><p>Most read stories of the week.</p></div></div>",
        f"<div class='header-fixed'><main>{STORY}</main></div><footer>Imprint</footer>",
        f"<article class='widget'>{STORY}</article>",
        f"<article>{STORY}</article><section class='comments'><article><p>I like this story a lot, thank you for it, and I hope that there are more like it.</p></article></section>",
        f"<div class='related'><article><p><a href=x>Another story</a></p></article></div><article>{STORY}</article>",
    ],
)
def test_class_words_are_hints(page):
    assert text_of(page) == TOLD


def test_links_and_hidden_parts():
    plain = "<p>It rained for two days and then the sun came out.</p>"
    told = "It rained for two days and then the sun came out."
    assert text_of(f"<article><a name=top>{plain * 3}</article>") == "\n".join([told] * 3)
    assert text_of(f"<div><a name=top></div>{plain}{plain}{plain}") == "\n".join([told] * 3)
    assert text_of(f"<div><a href=x>Home</div>{plain}{plain}") == "\n".join([told] * 2)
    assert text_of(f"<article>{plain}<p>One <span hidden>two <b>and</b></span> three <i style='display: none'>four</i> five</p></article>") == told + "\nOne three five"


def test_empty_share_and_extra_columns(spark):
    rows = [(1, "u", "<p>One sentence is here.</p>", 7), (2, "u", "", 7), (3, "u", None, 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert tuple(html_text.empty_share(html_text.extract(pages)).first()) == (3, 2, 2 / 3)
    long = spark.createDataFrame([(1, "u", f"<article>{'<p>The word is long.</p>' * 20_000}</article>")], "page_id long, url string, html string")
    assert html_text.extract(long).first().n_chars == 20_000 * 18 - 1


def test_long_broken_pages_are_linear():
    for page in ("<" * 200_000, "<p " * 60_000, "<a href='" * 50_000, "&" * 200_000, "<div>" * 20_000 + "x", "<!--" * 50_000):
        text_of(page)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p>One <svg class=i/> two</p><p>three</p></article>", "One two\nthree"),
        ("<article><p>One <svg class='i'><path d=x/><title>t</title></svg> two</p><p>three</p></article>", "One two\nthree"),
        ("<article><p>One <svg class=i> two</p><p>three</p><p>four <svg></svg></p></article>", "One\nthree\nfour"),
        ("<article><p>One <svg><foreignObject><p>no</p></foreignObject></svg> two</p></article>", "One two"),
        ("<article><p>One <noscript> two</p><p>three <template> four</p></article>", "One two\nthree four"),
        ("<article><title-bar>x</title-bar><p>three</p><template-x>y</template-x></article>", "x\nthree\ny"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds <math/> here.</p></article>", "So x=2 holds here."),
        ("<article><p>One <audio/> two <video src='a' /> three <object/> four</p></article>", "One two three four"),
        ("<article><script src='a'/><p>One</p><iframe src='b'/><p>two</p></article>", "One\ntwo"),
        ("<article><script>x</script foo><p>One</p></article>", "One"),
        ("<title>T</title ><article><p>One</p><textarea>no", "One"),
    ],
)
def test_nothing_is_cut_after_hidden_elements(page, want):
    assert text_of(page) == want


def test_unclosed_hidden_elements_are_linear():
    for page in ("<svg>" * 50_000, "<svg><p>" * 30_000 + "</svg>", "<noscript>" * 30_000, "<script/>" * 30_000, "<script>" + "</script " * 40_000, "<template><svg>" * 20_000):
        text_of(page)


def test_labelled_table_is_learnt():
    tree = html_text.train()
    for page, labels in html_text.LABELLED:
        found = html_text.blocks(page)
        kept = text_of(page).split("\n") if text_of(page) else []
        assert kept == [b.text for b, c in zip(found, labels, strict=True) if c == "1"]
    assert tree.depth <= 7


def test_edges(spark):
    rows = [(1, None, None), (None, "u", "<p>x</p>"), (2, "u", ""), (2, "u", "")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in out) == [("1", "", 0), ("2", "", 0), ("2", "", 0), ("None", "x", 1)]
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
