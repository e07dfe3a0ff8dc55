"""Main text of pages written for the case, and of the given pages against a cut by their markup."""

import html
import re

import pytest

from marketlane.llm import main_text, queries

ARTICLE = "<p>First &amp; long paragraph with a lot of words in it.</p><p>Second one,\n with  <i>in</i>line parts.</p>"
WANTED = "First & long paragraph with a lot of words in it. Second one, with inline parts."
CASES = {
    "nav and footer": f"<body><nav><a href=x>Menu</a></nav><article>{ARTICLE}</article><footer>&copy; us</footer></body>",
    "no article": f"<body><div id=top class='site-nav'><a>x</a><a>y</a></div><div class=content>{ARTICLE}</div><div class='sidebar'><p>Other text in a column.</p></div></body>",
    "adverts inside": f"<article>{ARTICLE}<div class='ad'>Buy this now, it is good.</div></article>",
    "comments": f"<main>{ARTICLE}</main><section id='comments'><p>I agree with all of this text.</p></section>",
    "notice": f"<div class='cookie-notice'>We use cookies on this site, accept?</div><article>{ARTICLE}</article>",
    "form and script": f"<article><script>var a = '<p>no</p>';</script><style>p{{}}</style>{ARTICLE}<form><p>Mail</p><input></form></article>",
    "unclosed": f"<html><body><ul class=menu><li>a<li>b</ul><article>{ARTICLE.replace('</p>', '')}",
    "comment and doctype": f"<!DOCTYPE html><!-- <p>no</p> --><article>{ARTICLE}<!-- x --></article>",
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    assert main_text.extract(CASES[name]) == WANTED


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), (" \n", ""), ("plain &lt;text", "plain <text"), ("<div><div>", ""), ("<", "<"), ("<p>a<p>b", "a b"), ("<script>x", "")])
def test_odd_pages(page, text):
    assert main_text.extract(page) == text


def test_deep_and_long_pages():
    assert main_text.extract("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert main_text.extract("<p>" + "word " * 200_000) == ("word " * 200_000).strip()


def test_title_in_the_article_stays():
    assert main_text.extract("<header>Site</header><article><header><h1>T</h1></header><p>Long text.</p></article>") == "T Long text."


def test_sibling_sections_all_stay():
    part = ["".join(f"<p>{c * 300}</p>" for c in cs) for cs in ("abcde", "fghij", "klmno")]
    text = [[c * 300 for c in cs] for cs in ("abcde", "fghij", "klmno")]
    menu = "<div><a href=x>One</a><a href=y>Two</a></div>"
    page = f"<body>{menu}<div>{part[0]}</div>{menu}<div>{part[1]}</div><div><div>{part[2]}</div></div></body>"
    assert main_text.extract(page) == " ".join(sum(text, []))
    two = f"<body>{menu}<article><h1>T</h1>{part[0]}</article>{menu}<article><h1>U</h1>{part[1]}{part[2]}</article></body>"
    assert main_text.extract(two) == " ".join(["T", *text[0], "U", *text[1], *text[2]])


def test_slugs_and_code_are_no_markers():
    own = (
        "<section id='related-work'><h2 id='share'>Share prices</h2><p>They fell.</p></section><h2 id='side-effects' class='notice'>Side effects</h2>"
        "<p>None <span class='comment'># so far</span>.</p><div class='notice'><p>Mind the <a href=x>gap</a>.</p></div>"
    )
    text = WANTED + " Share prices They fell. Side effects None # so far."
    links = "<div class='related'><a href=x>More</a> <a href=y>Else</a></div><div class='site-nav left'><a href=z>Up</a></div>"
    assert main_text.extract(f"<article>{ARTICLE}{own}{links}</article>") == text
    page = f"<body><div class='related-posts'>Other posts</div><div id='sidebar'>Column</div><div><p>{'x' * 300}</p><section id='related-work'><p>{'y' * 300}</p></section></div>"
    assert main_text.extract(page) == "x" * 300 + " " + "y" * 300


def test_given_pages(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    out = queries.QUERIES["op1_main_text"](spark, folder).collect()
    assert len(out) == len(pages)
    for r in out:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", pages[r.page_id], re.S)[1]
        parts = re.split(r"<[^>]*>", re.sub(r"</?b>", "", inner))
        assert r.text == " ".join(x for x in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts) if x)
        assert r.n_chars == len(r.text)


def test_columns_and_repeats(spark):
    df = spark.createDataFrame([(1, CASES["comments"], "a"), (1, CASES["comments"], "a"), (None, None, None)], "page_id long, html string, text string")
    out = main_text.with_text(df)
    assert out.columns == ["page_id", "html", "text"]
    assert sorted(r.text for r in out.collect()) == ["", WANTED, WANTED]
    assert main_text.with_text(df.limit(0)).count() == 0


def test_article_keeps_figures_and_loses_notices():
    page = "<article><p>Alpha text here.</p><figure><table><tr><td>cell one</td></tr></table><figcaption>Caption text.</figcaption></figure><p>Omega.</p>%s</article>"
    whole = "Alpha text here. cell one Caption text. Omega."
    assert main_text.extract(page % "") == whole
    for gone in ('<div class="notice">Mind this.</div>', '<div class="comments"><p>First!</p></div>', "<aside>Side.</aside>"):
        assert main_text.extract(page % gone) == whole
    for kept in ("<object>Stands in.</object>", "<math><mi>x</mi></math>", "<video>Stands in.</video>"):
        assert len(main_text.extract(page % kept)) > len(whole)
    assert main_text.extract("<main><p>Some text of the page.</p><section id='comments'><p>Mine.</p></section></main>") == "Some text of the page."
    assert main_text.extract("<article><h2 id='related'>Kept</h2><p>Text <span class='comment'>too</span>.</p></article>") == "Kept Text too."


def test_references_are_decoded_between_tags():
    assert main_text.extract("<article><p>R&<i>amp;</i> x &amp;amp; y</p></article>") == "R&amp; x &amp; y"


def test_deep_pages_take_no_long():
    import time

    began = time.process_time()
    page = "<body><article>" + "<section class='x y'></p>" * 20_000 + "<p>Deep text.</p>"
    assert main_text.extract(page) == "Deep text."
    assert time.process_time() - began < 5
