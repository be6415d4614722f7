"""Pages whose text the extraction must not lose, and parts that it must."""

from __future__ import annotations

import pytest

from corpusloom.llm.html_extract import extract

LONG = "Words, of an article, that run on, for a while, and say, a lot, about things that matter here."
MORE = "Another paragraph, with its own commas, and words, that belongs to the same article, as such."


def page(body, head="<head><title>T</title></head>"):
    return f"<!doctype html><html>{head}<body><nav><a href=/>Home</a></nav>{body}<footer>Foot</footer></body></html>"


@pytest.mark.parametrize("name, html, wanted", [
    ("head without its end", page(f"<article><p>{LONG}</p></article>", "<head><title>T</title><meta charset=utf-8>"), LONG),
    ("no head and body tags", f"<title>T</title><p>{LONG}<p>{MORE}", f"{LONG}\n{MORE}"),
    ("one form around the page", page(f"<form method=post><input type=hidden><div><p>{LONG}</p><p>{MORE}</p></div></form>"), f"{LONG}\n{MORE}"),
    ("a form around an article", page(f"<form><article><p>{LONG}</p></article></form>"), LONG),
    ("a form to fill in", page(f"<article><p>{LONG}</p><form><p>Your name, your mail</p><input></form></article>"), LONG),
    ("caption of a figure", page(f"<article><p>{LONG}</p><figure><img src=a><figcaption>A caption.</figcaption></figure><p>{MORE}</p></article>"), f"{LONG}\nA caption.\n{MORE}"),
    ("several articles", page(f"<main><article><p>{LONG}</p></article><article><p>{MORE}</p></article></main>"), f"{LONG}\n{MORE}"),
    ("names of sections", page(f'<article><h2 id="social-impact">Impact</h2><p class="notice-period">{LONG}</p><section id="related-work"><p>{MORE}</p></section></article>'), f"Impact\n{LONG}\n{MORE}"),
    ("names of other parts", page(f'<article><p>{LONG}</p><div class="related-posts"><p>Other, posts.</p></div><div id="comments-area"><p>I, say.</p></div><div class="shareBar">Share</div></article>'), LONG),
    ("links in an article", page(f"<article><p>{LONG}</p><ul><li><a href=/1>First source</a><li><a href=/2>Second source</a></ul></article>"), f"{LONG}\nFirst source\nSecond source"),
    ("links beside the text", page(f"<div><p>{LONG}</p><p>{MORE}</p><ul><li><a href=/1>First</a><li><a href=/2>Second</a></ul></div>"), f"{LONG}\n{MORE}"),
    ("links after a heading", page(f"<div><p>{LONG}</p><p>{MORE}</p><h2>References</h2><ul><li><a href=/1>First</a><li><a href=/2>Second</a></ul></div>"), f"{LONG}\n{MORE}\nReferences\nFirst\nSecond"),
    ("links in a named container", page(f'<div class="post-content"><ul><li><a href=/>Top</a><li><a href=/u>Up</a></ul><p>{LONG}</p><p>{MORE}</p><ul><li><a href=/1>First</a><li><a href=/2>Second</a></ul></div>'), f"{LONG}\n{MORE}\nFirst\nSecond"),
    ("words within values", page(f'<article data-title="The hidden cost"><p>{LONG}</p></article>'), LONG),
    ("words within names", f'<body data-nav-hidden="0"><div><p>{LONG}</p><p>{MORE}</p></div>', f"{LONG}\n{MORE}"),
    ("titles and alternative texts", page(f'<article><p>{LONG}</p><p title="hidden gem">A gem.</p><p alt=\'role="form" hidden\'>B gem.</p><div data-role="form">C gem.</div><p data-x=hidden>D gem.</p></article>'), f"{LONG}\nA gem.\nB gem.\nC gem.\nD gem."),
    ("forms of attributes", page(f'<article><p>{LONG}</p><p hidden>1</p><p HIDDEN="">2</p><p class = "ad" x>3</p><p class=ad>4</p><p class=\'ad\'>5</p><p aria-hidden=true>6</p><p role=form>7</p><p a=b/c=d hidden>8</p><p class="">Stays.</p></article>'), f"{LONG}\nStays."),
    ("parts within a line", page(f"<article><p>{LONG}</p><p>Press <button>Go</button> to store.</p><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p><p>See <svg><text>pic</text></svg> this<script>no()</script>.</p></article>"), f"{LONG}\nPress to store.\nLet x=1 hold.\nSee this."),
    ("articles in wrappers", page(f"<main><div><article><p>{LONG}</p></article></div><div><article><p>{MORE}</p></article></div></main>"), f"{LONG}\n{MORE}"),
    ("an article's standfirst", page(f"<article><header><h1>Title</h1><p>What it is about.</p><p>By Someone</p></header><p>{LONG}</p></article>"), f"Title\nWhat it is about.\n{LONG}"),
    ("end tags of list items and cells left out", page(f"<article><ul><li>One<li>Two</ul><table><tr><td>a<td>b<tr><td>c</table><p>{LONG}</article>"), f"One\nTwo\na\nb\nc\n{LONG}"),
    ("tables only", f"<table><tr><td>{LONG}<td>{MORE}<tr><td>{MORE}<td>{LONG}</table>", f"{LONG}\n{MORE}\n{MORE}\n{LONG}"),
    ("a table as layout", f"<table><tr><td><a href=/a>Menu</a><br><a href=/b>More</a><td><p>{LONG}<p>{MORE}</table>", f"{LONG}\n{MORE}"),
    ("an article's header", page(f'<article><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p></article>'), f"Title\n{LONG}"),
    ("the page's header", page(f'<div class="site-header"><p>Site, of, things.</p></div><div class=post><p>{LONG}</p><p>{MORE}</p></div>'), f"{LONG}\n{MORE}"),
])
def test_page(name, html, wanted):
    assert extract(html) == wanted


def test_long_pages_take_time_in_proportion():
    import time

    def took(n):
        start = time.process_time()
        assert extract("<article>" + f"<div><p>{LONG}</div>" * n).count("\n") == n - 1
        return time.process_time() - start

    took(200)
    assert took(8000) < 40 * max(took(400), 0.005)
