"""Ordinary pages whose article must not be lost, and pages of great length."""

import time

import pytest

from scholarlake.llm import html_extraction as he

STOPS = frozenset("the of and to in is a that it was".split())
P = "The quick brown fox of the north went to the river and it was a long day in the sun."
Q = "A second story of the same day, told by the fox that came to the river in the night before."
TEASER = "Read the other story that was told in town of the hen"

KEPT = [
    # Ends that may be left out.
    f"<html><head><title>t</title><body><article><p>{P}</p></article>",
    f"<html><head><title>t</title><meta charset=x><article><p>{P}</p></article>",
    f"<head><title>t</title><link rel=x><style>p {{}}</style><div><p>{P}</div>",
    f"<html><head><title>t</title>{P}",
    f"<article><p>{P}",
    f"<body><main><p>{P}</main><footer><p>{Q}</body>",
    # Names of themes.
    f'<div class="content with-sidebar"><article><p>{P}</p></article></div>',
    f'<div class="has-sidebar no-footer"><p>{P}</p></div>',
    f'<div class="sidebar-right"><main><p>{P}</p></main></div>',
    f'<div id="page" class="header-fixed footer-sticky"><main><p>{P}</p></main></div>',
    f'<article class="post category-social tag-form"><p>{P}</p></article>',
    f'<article class="hentry tag-ads format-standard"><p>{P}</p></article>',
    f'<article class="post has-sidebar"><p>{P}</p></article>',
    f'<main id="skip-target"><p>{P}</p></main>',
    f'<main class="widget-area"><p>{P}</p></main>',
    f'<body class="sidebar"><p>{P}</p></body>',
    f'<div class="post-header"><p>{P}</p></div>',
    f'<div class="social-science tagsoup noticeable"><p>{P}</p></div>',
    f'<form id="aspnetForm"><div><p>{P}</p></div></form>',
    f'<form method=post><main><p>{P}</p></main></form>',
    # No landmark, or one that has little.
    f'<div class="story"><p>{P}</p></div><article><a href=x>Other story</a></article>',
    f'<div class="story"><p>{P}</p></div><div class="related"><article><p>{TEASER}</p></article></div>',
    f'<div class="story"><p>{P}</p></div><aside><article><p>{Q} {Q}</p></article></aside>',
    f"<div><p>{P}</p></div>",
    f'<article><p>{P}</p></article><ol class="comment-list"><li class="comment"><article class="comment-body"><p>{Q} {Q}</p></article></ol>',
    # Icons, attributes, stray marks.
    f'<article><svg class=i/><p>{P}</p></article>',
    f"<article><p title=it's class=x>{P}</p></article>",
    f'<article><p data-x="a>b">{P}</p></article>',
    f"<article><p>{P}</p></article><a href='x",
]


@pytest.mark.parametrize("page", KEPT)
def test_the_article_is_kept(page):
    assert he.main_text(page, STOPS) == P


def test_formulas_are_text():
    page = f"<article><p>{P} Let <math><mi>x</mi><annotation>x_1</annotation></math> be so.</p></article>"
    assert he.main_text(page, STOPS) == f"{P} Let x be so."


def test_a_story_beside_a_teaser_with_text():
    page = f'<div class="story"><p>{P}</p></div><article><p>{TEASER}</p></article>'
    assert he.main_text(page, STOPS) == f"{P} {TEASER}"


def test_comments_longer_than_the_article_go():
    page = f'<article><p>{P}</p></article><section id="comments">' + f"<p>{Q}</p>" * 9 + "</section>"
    assert he.main_text(page, STOPS) == P
    assert he.main_text(page.replace("article>", "div>"), STOPS) == P


@pytest.mark.parametrize(
    "page",
    [
        "<ul>" + "<li>two words</li>" * 20_000 + "</ul>",
        "<article>" + "<li>two words" * 20_000,
        "<a '" * 40_000,
        '<a b="' * 40_000,
        "<!" * 40_000 + "<script " * 10_000,
        "<div>" * 20_000 + "</p>" * 20_000 + P,
        "<div class=sidebar>" * 20_000 + P + "</div>" * 20_000,
        "<head>" * 20_000 + P,
        "<div><article>" * 10_000 + P,
        "<p>" + "word " * 200_000,
        "&amp;<" * 50_000,
    ],
)
def test_time_is_in_proportion(page):
    start = time.process_time()
    he.main_text(page, STOPS)
    assert time.process_time() - start < 1
