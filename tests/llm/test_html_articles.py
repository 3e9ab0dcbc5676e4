"""Articles whose own parts look like boilerplate or raw elements."""

from __future__ import annotations

import pytest

from erpweave.llm import html_text

LONG = "Long text of the article stands here and goes on."


def text(page):
    return html_text.page_text(html_text.read_page(page), None)


@pytest.mark.parametrize(
    "part",
    [
        '<section id="discussion"><h2>D</h2><p>kept</p></section>',
        '<section id="related-work"><p>kept</p></section>',
        '<h2 id="search-algorithms">kept</h2>',
        "<h2 id=social-history>kept</h2>",
        "<h3 id='notice-of-appeal'>kept</h3>",
        '<ul><li id="menu-costs">kept</li></ul>',
        '<div data-id="comments" data-role="navigation" data-class="ad">kept</div>',
    ],
)
def test_ids_made_from_headings_do_not_mark(part):
    assert "kept" in text(f"<article><p>{LONG}</p>{part}<p>end</p></article>")


@pytest.mark.parametrize(
    "part",
    [
        '<section id="comments"><p>gone</p></section>',
        '<section class="related-posts"><p>gone</p></section>',
        '<div id="cookie-notice">gone</div>',
        "<div data-x='1' role=navigation>gone</div>",
        '<p class="advert">gone</p>',
        '<ul id="menu"><li>gone</li></ul>',
    ],
)
def test_boilerplate_still_goes(part):
    assert text(f"<article><p>{LONG}</p>{part}<p>end</p></article>") == f"{LONG} end"


@pytest.mark.parametrize(
    ("part", "want"),
    [
        ('<svg class="i"/> kept', "kept"),
        ("<svg/> kept <svg><text>gone</text></svg>", "kept"),
        ("<math><mi>x</mi></math> kept", "x kept"),
        ("<math/> kept", "kept"),
        ("<select-box>kept</select-box> <template-card>kept</template-card> <object-view>kept", "kept kept kept"),
        ("<noscript>one</noscript> <object>two</object> <canvas>three</canvas>", "one two three"),
        ("<template> kept", "kept"),
        ("<iframe src='x'> kept <select><option>gone</option></select>", "kept"),
        ("<script>gone '</p>' <!-- </script > kept <style>p {}</STYLE>", "kept"),
        ("kept <svg><title>gone</title></svg>", "kept"),
    ],
)
def test_raw_elements_end_where_they_end(part, want):
    assert text(f"<article><p>{LONG}</p><div>{part}</div><p>end</p></article>") == f"{LONG} {want} end"
    assert text(f"<article><p>{LONG}</p><script>never closed <p>gone</p></article>") == LONG
