"""A page's elements in one pass, for rules where nesting matters. A helper of the parser forms in ``operators.pages``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(["script", "style", "template"])  # their content isn't text


class Elements(HTMLParser):
    """Elements in document order. ``end`` is the number of the first element after it, so descendants are a range.

    An end tag closes the nearest open element of its name and what is open inside it; without one it is ignored.
    """

    def __init__(self, html: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.attributes: list[dict[str, str | None]] = []
        self.parents: list[int] = []
        self.ends: list[int] = []
        self.text_range: list[list[int]] = []
        self.pieces: list[str] = []
        self.open: list[int] = []
        self.data: list[str] = []
        self.feed(html or "")
        self.close()
        self._end_of_text()
        while self.open:
            self._close()

    def _close(self) -> None:
        i = self.open.pop()
        self.ends[i] = len(self.tags)
        self.text_range[i][1] = len(self.pieces)

    def _end_of_text(self) -> None:
        """What was read since the last markup is one text: the parser may hand it over in parts."""
        if self.data and (piece := "".join(self.data).strip()):
            self.pieces.append(piece)
        self.data.clear()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_of_text()
        i = len(self.tags)
        self.tags.append(tag)
        self.attributes.append(dict(attrs))
        self.parents.append(self.open[-1] if self.open else -1)
        self.ends.append(i + 1)
        self.text_range.append([len(self.pieces), len(self.pieces)])
        if tag not in VOID:
            self.open.append(i)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def handle_comment(self, data: str) -> None:
        self._end_of_text()

    def handle_endtag(self, tag: str) -> None:
        self._end_of_text()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.tags[self.open[depth]] == tag:
                while len(self.open) > depth:
                    self._close()
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.tags[self.open[-1]] in SILENT:
            return
        self.data.append(data)

    def text(self, i: int) -> str:
        """Text of the element and all within it, each piece stripped."""
        return "".join(self.pieces[slice(*self.text_range[i])])

    def starts_with_digit(self, i: int) -> bool:
        a, b = self.text_range[i]
        return a < b and self.pieces[a][0].isdigit()

    def inside(self, i: int, wanted: Callable[[int], bool]) -> Iterator[int]:
        return (k for k in range(i + 1, self.ends[i]) if wanted(k))

    def first(self, wanted: Callable[[int], bool]) -> int | None:
        return next((i for i in range(len(self.tags)) if wanted(i)), None)

    def ancestor(self, i: int, tag: str) -> int | None:
        i = self.parents[i]
        while i >= 0 and self.tags[i] != tag:
            i = self.parents[i]
        return i if i >= 0 else None

    def get(self, i: int, name: str) -> str:
        return self.attributes[i].get(name) or ""
