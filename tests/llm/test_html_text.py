"""Main text of many page shapes, of damaged markup, and of very deep pages."""

import itertools
import time

import pytest

from tallymark.llm.html_text import main_text

SIX = [f"Paragraph number {i}, long enough to be read, with commas, and a few more words for its length." for i in range(6)]
BODY = "".join(f"<p>{t}</p>" for t in SIX)
TEXT = " ".join(SIX)
NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
FOOT = "<footer>Copyright, all rights reserved, of somebody.</footer>"


@pytest.mark.parametrize("open_tag", [
    "<article>", "<main>", "<div>", "<section>", "<div class='overflow-hidden'>", "<article class='overflow-hidden'>",
    "<div title='the hidden truth'>", "<div data-menu=\"x\">", "<div class='post-content'>", "<div class=menu-of-the-week>",
    "<article class='share'>", "<div title=don't>", "<div class=a id=b style='color:red'>",
])
@pytest.mark.parametrize("around", ["{}", "<div>{}</div>", "<div class=wrap><div>{}</div></div>", "<table><tr><td>{}</td></tr></table>"])
def test_article_in_any_container(open_tag, around):
    name = open_tag[1:].split(">")[0].split()[0]
    page = f"<html><body>{NAV}<div class='ad'>Buy this, now.</div>{around.format(f'{open_tag}{BODY}</{name}>')}{FOOT}</body></html>"
    assert main_text(page) == TEXT


@pytest.mark.parametrize(("inner", "want"), [
    ("<p title='the hidden truth'>A titled word, kept.</p>", "A titled word, kept."),
    ("<p title=don't>An apostrophe, without quotes.</p>", "An apostrophe, without quotes."),
    ("<p>See <a href='/hidden-gems'>the gems</a> of the town, and stay.</p>", "See the gems of the town, and stay."),
    ("<div class='post-header'><h1>The title</h1></div>", "The title"),
    ("<p class='share-price'>The price rose, again.</p>", "The price rose, again."),
    ("<blockquote><p>As they said, it goes on.</p></blockquote>", "As they said, it goes on."),
    ("<ul><li>one thing</li><li>another thing</li></ul>", "one thing another thing"),
    ("<pre>code  here</pre>", "code here"),
    ("<p a=\"1>2\" b='<p>'>Signs in values.</p>", "Signs in values."),
    ("<p data-x='a\"b'>Quotes in quotes.</p>", "Quotes in quotes."),
])
@pytest.mark.parametrize("container", ["article", "div"])
def test_parts_of_an_article_stay(inner, want, container):
    assert main_text(f"<body>{NAV}<{container}>{inner}{BODY}</{container}>{FOOT}") == f"{want} {TEXT}"


def test_a_short_closing_section_stays():
    assert main_text(f"<div><div>{BODY}</div><div><p>A short closing.</p></div></div>") == f"{TEXT} A short closing."


@pytest.mark.parametrize("left_out", [
    "<div hidden>secret</div>", "<p aria-hidden=true>secret</p>", "<p style='display: none'>secret</p>", "<div class='hidden'>secret</div>",
    "<div class='cookie-notice'>secret</div>", "<div id=sidebar>secret</div>", "<div class='x article-comments'>secret</div>",
    "<section class='reader-comments'><p>secret</p></section>", "<form>secret</form>", "<script>secret</script>", "<style>secret</style>",
    "<div role=navigation>secret</div>", "<div class='siteFooter'>secret</div>", "<div class=related-posts>secret</div>",
    "<aside>secret</aside>", "<header>secret</header>", "<!-- secret -->", "<div class='main-nav'><a href=x>secret</a></div>",
])
def test_what_is_not_article_text_goes(left_out):
    for page in (f"<div>{left_out}{BODY}</div>", f"<article>{BODY}{left_out}</article>", f"<body>{left_out}<div>{BODY}</div>"):
        assert main_text(page) == TEXT


def test_generated_pages():
    """Sections of paragraphs, lists and tables, nested to any depth, between boilerplate of any kind."""
    boiler = [NAV, FOOT, "<div class=ad>Buy, buy.</div>", "<div id='newsletter'>Join us, now.</div>", "<aside>Beside, it.</aside>", ""]
    shapes = ["<p>{}</p>", "<div><p>{}</p></div>", "<section><h2>{}</h2></section>", "<blockquote>{}</blockquote>", "<p><b>{}</b></p>"]
    for n, (before, after, outer) in enumerate(itertools.product(boiler, boiler, ("article", "main", "div"))):
        blocks = [shapes[(n + i) % 5].format(t) for i, t in enumerate(SIX)]
        page = f"<html><head><title>t</title></head><body>{before}<{outer}>{''.join(blocks)}</{outer}>{after}</body></html>"
        assert main_text(page) == TEXT, page


@pytest.mark.parametrize("unit", ["<font><p>word, word", "<div>word, ", "<b><i>word ", "<span>x", "<li>one, ", "</x></b>y ", "<p title='"])
def test_deep_pages_take_linear_time(unit):
    start = time.perf_counter()
    main_text(unit * 20_000)
    assert time.perf_counter() - start < 3
