"""Web pages as element trees, by the standard library's parser.

Pages of plain markup, which most are, are cut at their tags; a tag that was seen before is not parsed again. Pages of one site
mostly have the same elements and differ in texts and addresses: ``Pages`` keeps the tree of such a page and fills it anew.
Anything that the expressions do not name goes, as a whole page, through the parser itself, which says what it means.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Hashable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open one of the listed kinds, up to the nearest table.
ENDS = {
    "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"),
    "thead": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th"),
    "li": ("li",), "option": ("option",), "p": ("p",),
}
HIDDEN = ("script", "style", "template")
#: Elements whose text the parser reads by rules of their own, and those where that differs only if the text has tags.
RAW = frozenset("script style xmp iframe noembed noframes noscript plaintext".split())
RAW_TEXT = frozenset(("title", "textarea"))
SHAPES = {"void": VOID, "raw": RAW, "text": RAW_TEXT, "hidden": frozenset(HIDDEN)}

_SPACE = r"[ \t\n\r\f]"
_VALUE = r"""(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=`]+)"""
#: Tags, comments and document types that can be read in one way only: quotes stand around values, no "<" or ">" stands inside.
_OPENED = rf"<[a-zA-Z][a-zA-Z0-9]*(?:{_SPACE}+[a-zA-Z][-a-zA-Z0-9_:.]*(?:={_VALUE})?)*{_SPACE}*>"
_COMMENT = r"<!--(?!-?>)[^-]*(?:-[^-]+)*-->"
PLAIN = re.compile(rf"({_OPENED}|</[a-zA-Z][a-zA-Z0-9]*>|{_COMMENT}|<![dD][oO][cC][tT][yY][pP][eE] [a-zA-Z]+>)")
#: Attributes whose values may say which element is meant; of the others a kept tree only knows that they are there.
LAYOUT = ("class", "rel")
#: Most kinds of tags, and most elements of kept trees, that a task remembers.
KINDS, KEPT = 1 << 16, 1 << 17


class Element:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None) -> None:
        self.tag = tag
        self.attributes = attributes
        self.parent = parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order."""
        todo = self.children[::-1]
        while todo:
            element = todo.pop()
            if type(element) is not str:
                yield element
                if element.children:
                    todo += element.children[::-1]

    def find(self, test: Callable[[Element], bool]) -> Element | None:
        return next((e for e in self.walk() if test(e)), None)

    def all(self, *tags: str) -> list[Element]:
        return [e for e in self.walk() if e.tag in tags]

    def classes(self) -> list[str]:
        named = self.attributes.get("class")
        return named.split() if named else []

    def strings(self) -> Iterator[str]:
        """Visible texts below, in document order."""
        todo: list[Element | str] = self.children[::-1]
        while todo:
            item = todo.pop()
            if type(item) is str:
                yield item
            elif item.tag not in HIDDEN:
                todo += item.children[::-1]

    def places(self) -> list[tuple[list, int]]:
        """Where the visible texts below stand, in document order: a list of children and a place in it."""
        found: list[tuple[list, int]] = []
        for at, child in enumerate(self.children):
            if type(child) is str:
                found.append((self.children, at))
            elif child.tag not in HIDDEN:
                found += child.places()
        return found

    def text(self) -> str:
        """Visible text with a space between elements and all white space collapsed."""
        if len(self.children) == 1 and type(self.children[0]) is str:
            return " ".join(self.children[0].split())
        return " ".join(" ".join(self.strings()).split())

    def joined(self) -> str:
        """Visible text without what surrounds it, elements joined without a space."""
        if len(self.children) == 1 and type(self.children[0]) is str:
            return self.children[0].strip()
        return "".join(s.strip() for s in self.strings())

    def owner(self, tag: str) -> Element | None:
        """The nearest element around this one with the tag."""
        at = self.parent
        while at is not None and at.tag != tag:
            at = at.parent
        return at


class Page(Element):
    """The root of a page, which may know what lies below in document order: all elements, and all texts if every one is visible."""

    __slots__ = ("elements", "texts", "found")

    def __init__(self, elements: list[Element] | None = None, texts: list[str] | None = None) -> None:
        super().__init__("", {}, None)
        self.elements, self.texts = elements, texts
        self.found: dict[Hashable, object] = {}

    def once(self, name: Hashable, look: Callable[[], object]):
        """What ``look`` finds by tags, the presence of attributes and the values of ``LAYOUT`` alone: looked up once for a kept tree."""
        if name not in self.found:
            self.found[name] = look()
        return self.found[name]

    def walk(self) -> Iterator[Element]:
        return super().walk() if self.elements is None else iter(self.elements)

    def strings(self) -> Iterator[str]:
        return super().strings() if self.texts is None else iter(self.texts)

    def release(self) -> None:
        """Untie children from parents, so that the tree goes with its last use and not with the next collection."""
        for element in [*self.walk()]:
            element.parent = None


def _close(opened: list[Element], tags: tuple[str, ...]) -> None:
    """Close the open elements of these kinds, up to the nearest table."""
    for at in range(len(opened) - 1, 0, -1):
        tag = opened[at].tag
        if tag in tags:
            del opened[at:]
            return _close(opened, tags)
        if tag == "table":
            return None
    return None


def _end(opened: list[Element], tag: str) -> None:
    for at in range(len(opened) - 1, 0, -1):
        if opened[at].tag == tag:
            del opened[at:]
            return
        if opened[at].tag == "table" and tag in ENDS:
            return


def _first_of_each(attributes: list) -> dict[str, str]:
    return {k: v or "" for k, v in reversed(attributes)}


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Page()
        self.open: list[Element] = [self.root]

    def handle_starttag(self, tag: str, attributes: list) -> None:
        _close(self.open, ENDS.get(tag, ()))
        element = Element(tag, _first_of_each(attributes), self.open[-1])
        self.open[-1].children.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        _end(self.open, tag)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


class _Tag(HTMLParser):
    """What one opening tag says."""

    def handle_starttag(self, tag: str, attributes: list) -> None:
        self.found = tag, _first_of_each(attributes)


@lru_cache(maxsize=8192)
def _mark(text: str) -> tuple[str, dict[str, str] | None, tuple[str, ...], str]:
    """Tag, attributes (none for an end), what it closes and its shape, of a tag as the parser reads it; no tag for what adds nothing.

    Elements of one spelling share their attributes.
    """
    if text[1] == "!":
        return "", None, (), ""
    if text[1] == "/":
        return text[2:-1].lower(), None, (), ""
    reader = _Tag()
    reader.feed(text)
    tag, attributes = reader.found
    return tag, attributes, ENDS.get(tag, ()), next((shape for shape, tags in SHAPES.items() if tag in tags), "")


class _Kinds(dict):
    """What a tree depends on of a tag, without its brackets, as a text; none for what is not plain."""

    def __missing__(self, mark: str) -> str | None:
        if len(self) >= KINDS:
            self.clear()
        kind = None
        if mark[:3] == "!--":  # adds nothing, and no two are alike
            return "" if PLAIN.fullmatch(f"<{mark}>") else None
        if PLAIN.fullmatch(f"<{mark}>"):
            tag, attributes, _, _ = _mark(f"<{mark}>")
            kind = f"/{tag}" if tag and attributes is None else tag and " ".join([tag, *(
                f"{name}={attributes[name]!r}" if name in LAYOUT else name for name in sorted(attributes))])
        self[mark] = kind
        return kind


_KINDS = _Kinds()
_NO_BRACKETS = bytes(set(range(256)) - set(b"<>"))


def _cut(html: str) -> tuple[list[str], list[str], tuple[str, ...]] | None:
    """Tags without their brackets, the texts before, between and after them, and the tags' kinds; none if a page is not plain."""
    if "<script" in html or "<style" in html:
        return None
    brackets = html.encode("utf-8", "surrogatepass").translate(None, _NO_BRACKETS)
    if brackets == b"<>" * (len(brackets) // 2):  # every piece between brackets is a tag
        pieces = html.replace("<", ">").split(">")
        marks, texts = pieces[1::2], pieces[::2]
    else:
        pieces = PLAIN.split(html)
        marks, texts = [mark[1:-1] for mark in pieces[1::2]], pieces[::2]
        if any("<" in text for text in texts):
            return None
    kinds = tuple(map(_KINDS.__getitem__, marks))
    if None in kinds or "&" in texts[-1]:
        return None
    if "&" in html:
        whole = unescape("<".join(texts)).split("<")  # no reference goes beyond a "<"
        texts = whole if len(whole) == len(texts) else [unescape(text) if "&" in text else text for text in texts]
    return marks, texts, kinds


def _grow(marks: list[str], texts: list[str], places: list[tuple[list, int]] | None = None) -> Page | None:
    """The tree of a page of plain markup, none if the parser would read it otherwise.

    With ``places`` empty texts have a place, too, and the place of each text is added to that list.
    """
    elements: list[Element] = []
    seen: list[str] = []
    page = Page(elements, seen)
    opened: list[Element] = [page]
    inner, children, raw = page, page.children, ""
    for at, text in enumerate(texts):
        if text or places is not None:
            if places is not None:
                places.append((children, len(children)))
            children.append(text)
            seen.append(text)
        mark = marks[at] if at < len(marks) else ""
        if raw:
            if mark.lower() != f"/{raw}":
                return None
            raw = ""
        if not mark:
            break
        tag, attributes, ends, shape = _mark(f"<{mark}>")
        if attributes is None:
            if inner.tag == tag and inner is not page:
                opened.pop()
            elif tag:
                _end(opened, tag)
            inner = opened[-1]
            children = inner.children
            continue
        if ends:
            _close(opened, ends)
            inner = opened[-1]
            children = inner.children
        element = Element(tag, attributes, inner)
        children.append(element)
        elements.append(element)
        if shape:
            if shape == "raw":
                return None
            if shape == "text":
                raw = tag
            if shape == "hidden":
                page.texts = None
            if shape == "void":
                continue
        opened.append(element)
        inner, children = element, element.children
    return page


def _plain(html: str) -> Page | None:
    """The tree of a page of plain markup, none for any other."""
    cut = _cut(html)
    return None if cut is None else _grow(cut[0], cut[1])


def _by_parser(html: str) -> Page:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def parse(html: str | None) -> Page:
    """The tree of a page; what is missing or malformed ends up as the parser finds it, never as an error."""
    page = _plain(html or "")
    return _by_parser(html or "") if page is None else page


class _Kept:
    """A tree whose texts and attributes are replaced by those of another page of the same elements."""

    def __init__(self, page: Page, places: list[tuple[list, int]], marks: list[str]) -> None:
        self.page = page
        self.lists, self.places = [children for children, _ in places], [at for _, at in places]
        # a tag that opens an element, in the order of the elements; what its kind does not tell is read again
        opening = [at for at, mark in enumerate(marks) if mark[0] not in "/!"]
        self.varied = [(e, at) for e, at in zip(page.elements, opening) if e.attributes.keys() - set(LAYOUT)]

    def fill(self, marks: list[str], texts: list[str]) -> Page:
        deque(map(list.__setitem__, self.lists, self.places, texts), maxlen=0)
        for element, at in self.varied:
            element.attributes = _mark(f"<{marks[at]}>")[1]
        if self.page.texts is not None:
            self.page.texts = texts
        return self.page


class Pages:
    """Trees of one page after the other. A tree holds until the next page is asked for.

    It is that of ``parse``, but for empty texts, which it may have. A bounded number of elements is kept; beyond it all are forgotten.
    """

    def __init__(self) -> None:
        self.kept: dict[tuple[str, ...], _Kept] = {}
        self.elements = 0
        self.last: Page | None = None

    def _forget(self) -> None:
        for kept in self.kept.values():
            kept.page.release()
        self.kept, self.elements = {}, 0

    def page(self, html: str | None) -> Page:
        if self.last is not None:
            self.last.release()
            self.last = None
        cut = _cut(html or "")
        if cut is not None:
            marks, texts, kinds = cut
            kept = self.kept.get(kinds)
            if kept is not None:
                return kept.fill(marks, texts)
            places: list[tuple[list, int]] = []
            page = _grow(marks, texts, places)
            if page is not None:
                if self.elements + len(marks) > KEPT:
                    self._forget()
                self.elements += len(marks)
                self.kept[kinds] = _Kept(page, places, marks)
                return page
        self.last = _by_parser(html or "")
        return self.last
