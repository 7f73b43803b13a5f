"""Trees that are kept and filled again say the same of a page as a tree of its own."""

from __future__ import annotations

import random

from test_markup import BITS, by_parser, shape

from urndraw.functions import markup

SKELETONS = ["<p class=a>{}</p><a href='/{}'>{}</a>", "<title>{}</title><div id={}>x{}</div>", "{}<!-- <b> --><td>{}<td>{}", "<template>{}</template><i>{}</i>{}"]


def without_empty(found):
    tag, attributes, children = found
    return tag, attributes, [c if isinstance(c, str) else without_empty(c) for c in children if c != ""]


def same(page, html):
    wanted = by_parser(html)
    assert without_empty(shape(page)) == without_empty(shape(wanted)), html
    assert [e.tag for e in page.walk()] == [e.tag for e in wanted.walk()], html
    assert [s for s in page.strings() if s] == [*wanted.strings()] and page.text() == wanted.text(), html
    assert [texts[at] for texts, at in page.places() if texts[at]] == [*wanted.strings()], html


def test_any_markup_gives_the_tree_of_the_parser_in_any_order():
    random.seed(7)
    trees = markup.Pages()
    for _ in range(20000):
        html = "".join(random.choice(BITS) for _ in range(random.randint(1, 6)))
        same(trees.page(html), html)


def test_a_kept_tree_has_the_texts_and_addresses_of_each_page():
    random.seed(8)
    trees = markup.Pages()
    for _ in range(3000):
        html = random.choice(SKELETONS).format(*[random.choice(["", "1", " x ", "&lt;b", "a&amp;b", "&nbsp;7"]) for _ in range(3)])
        same(trees.page(html), html)
    assert len(trees.kept) < 20


def test_pages_of_the_same_elements_share_one_tree(monkeypatch):
    made = []
    grow = markup._grow
    monkeypatch.setattr(markup, "_grow", lambda *a: made.append(a) or grow(*a))
    trees = markup.Pages()
    for n in range(50):
        page = trees.page(f"<div id='day_{n}'><a href='/x{n}.html' class=b>{n}</a></div>")
        assert [e.attributes for e in page.walk()] == [{"id": f"day_{n}"}, {"href": f"/x{n}.html", "class": "b"}] and page.text() == str(n)
        assert page.once("links", lambda: page.all("a"))[0].attributes["href"] == f"/x{n}.html"
    assert len(made) == 1


def test_the_class_says_which_tree(monkeypatch):
    trees = markup.Pages()
    for css in ("a", "b", "a"):
        page = trees.page(f"<p class='{css}'>1</p>")
        assert [e.text() for e in page.once("found", lambda: [e for e in page.walk() if "a" in e.classes()])] == ["1"] * (css == "a")


def test_a_bounded_number_of_elements_is_kept(monkeypatch):
    monkeypatch.setattr(markup, "KEPT", 100)
    trees = markup.Pages()
    for n in range(60):
        html = f"<p class=a{n}>{n}<br></p>"
        same(trees.page(html), html)
        assert trees.elements <= 100
