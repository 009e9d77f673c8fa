"""Hostile markup, names with hints in their parts, and the cut against all labellings."""

import itertools
import random
import time

import pytest

from regflat.llm import html_text

STORY = "This is a long story of the land and its people. " * 10
REMARK = "Great post, I liked it much, thank you."


@pytest.mark.parametrize("unit", [
    "<a ", '<a "', """<a "'<b ' """, "<!", "<!--", "<div>", "<iframe/>", "</svg ", "<div class=ad>x ",
    '<div class="x-ad">w ', "<li>some words here, of a list</li><p>more words</p>", "<i>"])
def test_time_follows_the_length(unit):
    """200 KB of the same unit; where time grows with the square of the length this takes minutes."""
    start = time.time()
    html_text.main_text(unit * (200_000 // len(unit)) + "<p>end</p>")
    assert time.time() - start < 10


def test_long_closings_and_blocks_in_deep_elements():
    start = time.time()
    assert html_text.main_text("<div>" * 30_000 + "</b>" * 30_000 + f"<p>{STORY}</p>") == STORY.strip()
    html_text.main_text("<i>" * 50_000 + "<div>x</div>" * 15_000)
    assert time.time() - start < 10


@pytest.mark.parametrize("page,text", [
    ("<p>a < b and <c d", "a < b and <c d"),
    ("<p title='1 > 0'>It is.</p>", "It is."),
    ("<p>One.</p><p title=\"open>Two.</p>", "One.\n\n<p title=\"open>Two."),
    ("<p>One.</p><!-- never shut <p>Two.</p>", "One."),
    ("<p>One.<!doctype x>", "One."),
    ("<p>One.<!", "One.<!"),
    ("<", "<"),
])
def test_ends_of_tags(page, text):
    found, _ = html_text.blocks(page)
    assert "\n\n".join(b.text for b in found) == text


@pytest.mark.parametrize("name", ["user-comment", "article__sidebar", "ad-728", "sidebar-left", "js_ad_slot"])
@pytest.mark.parametrize("page", [
    "<article><p>{s}</p><div class='{n}'><p>{r}</p></div></article>",
    "<article><p>{s}</p></article><div id='{n}'><p>{r}</p></div>",
    "<div><p>{s}</p></div><div class='{n}'><p>{r}</p></div>"])
def test_hints_in_parts_of_names(name, page):
    assert html_text.main_text(page.format(s=STORY, r=REMARK, n=name)) == STORY.strip()


@pytest.mark.parametrize("name", ["content with-nav", "site has-sidebar", "x-sidebar", "no-sidebar", "search-page"])
def test_names_of_the_frame_and_of_the_layout_say_nothing(name):
    assert html_text.main_text(f"<div class='{name}'><p>{STORY}</p></div>") == STORY.strip()


def test_layout_names_on_small_elements_say_nothing():
    page = f"<article><p>{STORY}</p><div class='no-sidebar'><p>{REMARK}</p></div></article>"
    assert html_text.main_text(page).endswith(REMARK)


def test_cut_is_the_greatest_least_cut():
    rnd = random.Random(7)
    for _ in range(300):
        n = rnd.randint(1, 9)
        content, other = ([float(rnd.randint(0, 6)) for _ in range(n)] for _ in range(2))
        edges = [(a, b, float(rnd.randint(1, 4))) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.5]

        def cost(sides):
            return sum(other[i] if s else content[i] for i, s in enumerate(sides)) + sum(
                w for a, b, w in edges if sides[a] != sides[b])

        best = min(itertools.product([False, True], repeat=n), key=lambda s: (cost(s), -sum(s)))
        assert html_text.minimum_cut(content, other, edges) == list(best)
