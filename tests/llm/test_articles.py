"""Articles within forms, with formulas, lists of sources and ordinary words as classes."""

from __future__ import annotations

import pytest

from daylake.llm import html

TEXT = " ".join(["A sentence of the article that is long enough."] * 5)
LINKS = "<ul>" + "".join(f"<li><a href='/{n}'>Source {n}</a></li>" for n in range(4)) + "</ul>"


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_a_form_may_wrap_the_page(tag):
    page = f"<body><form id=aspnetForm><nav>Menu</nav><{tag}><p>{TEXT}</p><p>{TEXT}</p></{tag}><input value=x></form></body>"
    assert html.main_text(page) == f"{TEXT} {TEXT}"


def test_a_form_within_the_article_goes():
    form = "<form><label>Your name</label><input><button>Send</button></form>"
    assert html.main_text(f"<body><article><p>{TEXT}</p>{form}</article></body>") == TEXT
    assert html.main_text(f"<body><form><article><p>{TEXT}</p>{form}</article></form></body>") == TEXT
    assert html.main_text(f"<body><div><p>{TEXT}</p><p>{TEXT}</p></div>{form}</body>") == f"{TEXT} {TEXT}"


def test_formulas_are_text():
    formula = "<math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1 in TeX</annotation></math>"
    assert html.main_text(f"<body><article><p>{TEXT} If {formula} holds.</p></article></body>") == f"{TEXT} If x=1 holds."


def test_links_after_the_text_are_sources_and_before_it_a_menu():
    sources = "Source 0 Source 1 Source 2 Source 3"
    assert html.main_text(f"<body><article><p>{TEXT}</p>{LINKS}</article></body>") == f"{TEXT} {sources}"
    assert html.main_text(f"<body><article>{LINKS}<p>{TEXT}</p></article></body>") == TEXT
    assert html.main_text(f"<body><main><article><p>{TEXT}</p></article>{LINKS}</main></body>") == TEXT


@pytest.mark.parametrize("name", ["alert-box", "search-results-analysis", "widget-theory", "hidden-costs", "social-history"])
def test_weak_marks_within_an_article_are_words(name):
    part = f"<div class='{name}'><p>Part.</p></div>"
    assert html.main_text(f"<body><article><p>{TEXT}</p>{part}</article></body>") == f"{TEXT} Part."
    beside = f"<body><div class='{name}'><p>Part.</p></div><article><p>{TEXT}</p></article></body>"
    assert html.main_text(beside) == TEXT


@pytest.mark.parametrize("name", ["alert", "widget", "share-buttons", "related-posts", "newsletter", "x comments", "ad-slot"])
def test_marks_that_stand_alone_or_say_so_go(name):
    part = f"<div class='{name}'><p>Part.</p></div>"
    assert html.main_text(f"<body><article><p>{TEXT}</p>{part}</article></body>") == TEXT


def test_the_innermost_article_holds_the_text():
    beside = "<div><p>Read also this other story.</p></div>"
    assert html.main_text(f"<body><main><article><p>{TEXT}</p><p>{TEXT}</p></article>{beside}</main></body>") == f"{TEXT} {TEXT}"
