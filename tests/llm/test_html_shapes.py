"""Page shapes without a plain article element, marks by whole names, inline adverts, depth."""

from __future__ import annotations

import time

import pytest

from erpweave.llm import html_text

LONG = "Long text of the article stands here and goes on and on, for a while."


def text(page, path=None):
    return html_text.page_text(html_text.read_page(page), path)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<div class="post"><h1>Title</h1><p>Intro</p><section><p>{LONG}</p></section></div>', f"Title Intro {LONG}"),
        (f'<div class="post"><section><p>One.</p></section><section><p>{LONG}</p></section></div>', f"One. {LONG}"),
        (f"<div><p>Before</p><blockquote><p>{LONG}</p></blockquote><p>After</p></div>", f"Before {LONG} After"),
        (f"<div><p>Before</p><table><tr><td>{LONG}</td><td>x</td></tr></table><p>After</p></div>", f"Before {LONG} x After"),
        (f'<table><tr><td><a href="/">Home</a></td><td><h1>T</h1><p>{LONG}</p></td></tr></table>', f"T {LONG}"),
        (f'<div class="content-sidebar-wrap"><article><p>{LONG}</p></article></div>', LONG),
        (f'<div class="layout has-sidebar"><main><p>{LONG}</p></main></div>', LONG),
        (f'<div class="sidebar-page"><main><p>{LONG}</p></main><div class="sidebar">gone</div></div>', LONG),
        (f'<div class="newsletter"><p>{LONG}</p></div>', LONG),
        (f'<div id="a"><p>{LONG}</p></div><div class="comments"><article class="comment"><p>{LONG} {LONG}</p></article></div>', LONG),
        (f'<div class="discussion"><p>gone gone</p></div><div class="text"><p>{LONG}</p></div>', LONG),
    ],
)
def test_shapes(page, want):
    assert text(f"<html><body><nav><a href='/'>Menu</a></nav>{page}<footer>foot</footer></body></html>") == want


@pytest.mark.parametrize(
    ("part", "kept"),
    [
        ('<div class="search-algorithms">part</div>', True),
        ('<div class="discussion">part</div>', True),
        ('<div class="social-history">part</div>', True),
        ('<div class="no-comments">part</div>', True),
        ('<div class="search-form">part</div>', False),
        ('<div class="site-header">part</div>', False),
        ('<div class="related-posts">part</div>', False),
        ('<div class="share-buttons">part</div>', False),
        ('<div class="comment-list">part</div>', False),
        ('<div class="cookie-notice">part</div>', False),
        ('<div class="content-ads-wrap">part</div>', False),
        ('<span class="advert">part</span>', False),
        ('<span class="advert">part <span>part</span> <b>part</b> part</span>', False),
        ('<ins class="adsbygoogle"><div>part</div> part</ins>', False),
        ('<a class="sponsored" href="/x">part</a>', False),
        ('<span class="header">part</span>', True),
    ],
)
def test_marks_by_whole_names(part, kept):
    got = text(f"<article><p>{LONG}</p>{part}<p>end</p></article>")
    assert got == (f"{LONG} part end" if kept else f"{LONG} end")


def test_an_inline_advert_leaves_the_words_around_it_alone():
    assert text(f"<article><p>{LONG} one<span class=ad>gone</span> two <span>kept</span></p><p>end</p></article>") == f"{LONG} one two kept end"
    assert text(f"<article><p>{LONG} <span class=ad>not closed</p><p>end</p></article>") == f"{LONG} end"


def test_paths_are_found_from_the_root():
    page = html_text.read_page(f"<body><div class='x 1'><div class=y>a</div><div class=y>{LONG}</div></div><div class=y>b</div></body>")
    node, _ = html_text.best_container(page)
    path = page.path(node)
    assert page.on_path(path) == {i for i in range(1, len(page.parent)) if page.path(i) == path} and len(page.on_path(path)) == 2


def test_deep_pages_take_time_in_proportion():
    def seconds(n, tag):
        source = f"<{tag} class=a>" * n + f"<p>{LONG}" + "</dd></li>" * n
        start = time.monotonic()
        page = html_text.read_page(source)
        path = page.path(html_text.best_container(page)[0])
        assert LONG in html_text.page_text(page, path)
        return time.monotonic() - start

    for tag in ("div", "pre", "main"):
        seconds(500, tag)
        assert seconds(8000, tag) < 16 * max(0.05, seconds(1000, tag)), tag
