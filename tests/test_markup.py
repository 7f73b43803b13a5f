"""Pages of plain markup are read without the parser, and read as the parser reads them."""

from __future__ import annotations

import random

import pytest
from test_pages import page

from urndraw.functions import markup

BITS = [
    "<div>", "</div>", '<p class="a&amp;b">', "<p class=a>", "<a href=/x/>", "<br/>", "<br>", "<title>", "</title>", "<script>", "</script>", "text", "&amp;",
    "&lt", "&", "<", ">", '"', "'", "<!-- x -->", "<!-->", "<!-- a--b -->", "<!--->", "<td>", "<tr>", "<table>", "</table>", "</tr>", "<A B=c B=d>", "<textarea>",
    "</TEXTAREA>", "\n", " ", '<img src="a>b">', "</p >", "</", "<?x?>", "<![CDATA[x]]>", "<!doctype html>", "<TITLE a>", "--", "-", "!", "\x00", "<x y>", "<style>",
    "</style>", "<template>", "</template>", "<noscript>", "<plaintext>", "=", "<svg>", "é", "<a é=1>", '<a x="\n">', "&#x41;", "<p a='b'c=d>", '<p a="b"c=d>', "<b/>", "<li>"]


def by_parser(html):
    builder = markup._Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def shape(element):
    return element.tag, element.attributes, [c if isinstance(c, str) else shape(c) for c in element.children]


def test_any_markup_gives_the_tree_of_the_parser():
    random.seed(5)
    plain = 0
    for _ in range(20000):
        html = "".join(random.choice(BITS) for _ in range(random.randint(1, 10)))
        found, wanted = markup.parse(html), by_parser(html)
        plain += markup._plain(html) is not None
        assert shape(found) == shape(wanted), html
        assert [e.tag for e in found.walk()] == [e.tag for e in wanted.walk()] and list(found.strings()) == list(wanted.strings()), html
    assert plain > 1000


@pytest.mark.parametrize("html", [page(), page(extra="<!-- <b>x</b> --><p class='a b'>&nbsp;y</p>"), "<table class='table-xsaa'><tbody><tr><th>8<td><span class=xs_prize1>1<br>2</span></td></tr></tbody></table>"])
def test_plain_pages_do_not_go_through_the_parser(monkeypatch, html):
    wanted = shape(by_parser(html))

    def refuse(*_):
        raise AssertionError("parsed")

    monkeypatch.setattr(markup._Builder, "feed", refuse)
    assert shape(markup.parse(html)) == wanted
