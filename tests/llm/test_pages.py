"""Main text of pages as they are found in the wild."""

import time

import pytest

from trawl.llm.html_text import main_text, parse


def text(page):
    return main_text(parse(page), None)[0]


@pytest.mark.parametrize(
    "page, wanted",
    [
        # end tags that HTML lets out
        ('<article><h1>T</h1><p class="notice">No<p>One.<h2>H</h2><p>Two.</article>', ["T", "One.", "H", "Two."]),
        ('<article><ul><li class="ad">no<li>a<ul><li>b</ul><li>c</ul></article>', ["a", "b", "c"]),
        ('<article><dl><dt class="promo">no<dd>a<dt>b</dl></article>', ["a", "b"]),
        ("<article><table><tr><td class=ad>no<td>a<tr><td>b</table>c</article>", ["a", "b", "c"]),
        ('<article><p>a<div class="ad">no</p>no</div>b</article>', ["a", "b"]),
        ("<article><h2>a</h3><p>b</article>", ["a", "b"]),
        # an end tag of a span ends no block around it
        ('<span><article><div class="ad"><b>no</span>no</div>a</article></span>', ["a"]),
        # names that tell of another thing
        ('<div class="elementor-widget-container"><p>a</div>', ["a"]),
        ('<article><section class="share-price">a</section><p id="social-science">b</article>', ["a", "b"]),
        ('<article><p class="related-work">a<div class="page-with-sidebar">b</div></article>', ["a", "b"]),
        ('<article class="post social">a</article>', ["a"]),
        # names of menus and the like
        ('<article>a<div class="related-posts">no</div><div id="sidebar-2">no</div></article>', ["a"]),
        ('<article>a<div class="widget">no</div><div class="site-footer">no</div></article>', ["a"]),
        # readers' comments
        ('<article>a<article class="comment">no</article></article><article class="comment">no</article>', ["a"]),
        # quotes that open no value, and values that hold a tag's end
        ('<article><p title="5" tall">a <a href=x\'>b</a> <a title="c>d">e</a></article>', ["a b e"]),
        ('<article>a <a href="cut', ["a"]),
        ("", []),
        (" <!-- x", []),
    ],
)
def test_text(page, wanted):
    assert text(page) == "\n\n".join(wanted)


@pytest.mark.parametrize(
    "page",
    [
        "<article>" + "<b>" * 100_000 + "x</article>",
        "<div>" * 50_000 + "x" + "</span>" * 50_000 + "</i>" * 50_000,
        "<noscript>" * 50_000 + "x",
        "<svg>x" + "</svg" * 50_000,
        "x<a " * 50_000,
        "x" + '<a b="' * 50_001,
    ],
)
def test_time_grows_with_the_page(page):
    began = time.process_time()
    parse(page)
    assert time.process_time() - began < 5
