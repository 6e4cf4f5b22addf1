"""Main text of pages whose names, attributes and nesting mislead, and the time that odd pages take."""

import time

import pytest

from martwright.llm.pages import main_text

A = "The committee met on Tuesday to discuss the plans for the new bridge over the river. It will open next year."
B = "Several members asked about the cost, which has grown since the first estimate was made two years ago."
ARTICLE, TEXT = f"<p>{A}</p><p>{B}</p>", f"{A} {B}"


@pytest.mark.parametrize(
    "name, html, text",
    [
        ("form",f'<form id="aspnetForm"><div class="content">{ARTICLE}</div></form>',TEXT),
        ("search-page",f'<div id="search-page"><div class="content">{ARTICLE}</div></div>',TEXT),
        ("side",f'<div class="side-by-side">{ARTICLE}</div>',TEXT),
        ("legal",f'<div class="legal-content">{ARTICLE}</div>',TEXT),
        ("apos",f"<article><p data-x=it's>{A}</p><p>{B}</p></article>",TEXT),
        ("hello","<p>Hello</p>","Hello"),
        ("list","<ul><li>One apple<li>Two pears<li>Milk</ul>","One apple Two pears Milk"),
        ("related-work",f'<article><h1>On bridges</h1>{ARTICLE}<section id="related-work"><h2>Related work</h2><p>{A}</p></section></article>',f"On bridges {TEXT} Related work {A}"),
        ("quote",f'<article><p class="x"">{A}</p>{ARTICLE}</article>',f"{A} {TEXT}"),
        ("feedback",f'<article>{ARTICLE}</article><div class="user-feedback"><p>I liked this very much, thank you for writing it up.</p><p>{B}</p></div>',TEXT),
        ("cmp",f'<article>{ARTICLE}</article><div class="cmp"><p>We use cookies to improve this site. Accept all or change your settings.</p></div>',TEXT),
        ("cookie2",f'<article>{ARTICLE}</article><div class="x9"><p>We use cookies to improve this site. Accept all or change your settings.</p></div>',TEXT),
        ("header in art",f'<article><header><h1>Big title here</h1></header>{ARTICLE}</article>',f"Big title here {TEXT}"),
        ("cl",f'<article>{ARTICLE}</article><div class="comment-list"><p>{A}</p><p>{B}</p><p>{A}</p></div>',TEXT),
        ("bogus",f'<article>{ARTICLE}<!x><?php echo ?></ x><!-- a <p>no</p> --></article>',TEXT),
    ],
)
def test_page(name, html, text):
    assert main_text(html) == text
    if len(text) > 50:  # a word or two after a menu may belong to it
        assert main_text(f"<!DOCTYPE html><html><body><nav><a href=/>Home</a> <a href=/x>More</a></nav>{html}</body></html>") == text


PIECES = ["<a '", "<a x='", "<div>", "<div></p>", "<!", "</", "<b><div>", "<i></b>", "<p", "<script>", "<p a=b ", "&amp", "< ",
          "<p>a b c d</p>", "<p>a <a href=x>b c d</a>.", "<li>one two. <div>", "<div class=nav>x</div>words here now."]


@pytest.mark.parametrize("piece", PIECES)
def test_time_is_linear_in_the_page(piece):
    times = []
    for size in (100_000, 800_000):
        html, began = piece * (size // len(piece)), time.process_time()
        main_text(html)
        times.append(time.process_time() - began)
    assert times[1] < 12 * times[0] + 2


def test_unmatched_ends_below_many_open_elements():
    began = time.process_time()
    main_text("<div>" * 30_000 + "</p>" * 200_000 + "text")
    assert time.process_time() - began < 10
