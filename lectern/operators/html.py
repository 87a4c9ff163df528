"""A small element tree over the standard library's HTML parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An open element of the same group is closed by the next one, up to its container.
_IMPLIED = {"li": ({"li"}, {"ol", "ul"}), "p": ({"p"}, {"div", "article", "section", "body", "li"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}


class Element:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def attr(self, name: str) -> str:
        return self.attrs.get(name, "")

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    def descendants(self) -> Iterator[Element]:
        """In document order, without the element itself."""
        stack = self.elements()[::-1]
        while stack:
            node = stack.pop()
            yield node
            stack += node.elements()[::-1]

    def text(self) -> str:
        return "".join(self._texts(lambda e: False))

    def text_without(self, skip) -> str:
        return "".join(self._texts(skip))

    def _texts(self, skip) -> Iterator[str]:
        stack: list = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif not skip(node):
                stack += node.children[::-1]

    def remove(self, tags: set[str]) -> None:
        stack = [self]
        while stack:
            node = stack.pop()
            node.children = [c for c in node.children if not (isinstance(c, Element) and c.tag in tags)]
            stack += node.elements()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("#document", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _IMPLIED:
            ends, stops = _IMPLIED[tag]
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in stops:
                    break
                if self.open[i].tag in ends:
                    del self.open[i:]
                    break
        known: dict[str, str] = {}
        for name, value in attrs:
            known.setdefault(name, value or "")
        node = Element(tag, known)
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # as in HTML, the slash closes void elements only

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
