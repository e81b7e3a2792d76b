"""A page as flat tables, filled by one pass of the tokenizer.

Elements are numbered in document order. ``stream`` is the page as one list: i where
element i opens, ~i where it closes, and texts between; what lies inside an element is
a slice of it, and the elements inside are a range of numbers. All views of a page
(visible lines, metadata, scripts, cards) are reads of these tables.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import accumulate

# Tags that begin a line, that hide their text, that have no end.
BLOCK_TAGS = frozenset(["address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"])
SILENT_TAGS = frozenset(["style", "noscript", "svg", "canvas", "template"])
VOID_TAGS = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"])
# In cards these tags begin a line, and these hide their text.
CARD_LINE_TAGS = frozenset(["div", "p", "br", "span", "li", "a"])
CARD_SILENT_TAGS = frozenset(["script", "style", "svg", "noscript"])


class Markup(HTMLParser):
    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.source = source
        self.row_at = [0, *accumulate(len(x) + 1 for x in source.split("\n"))]
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.up: list[int] = []  # the element around; -1: none
        self.inner: list[int] = []  # one more than the last element inside
        self.cut: list[tuple[int, int]] = []  # where the element stands in the stream
        self.span: list[tuple[int, int]] = []  # where it stands in the source
        self.stream: list[int | str] = []
        self.layer: list[int] = []  # of each entry of the stream: 0 shown, 1 hidden, 2 script, 3 a break between visible lines
        self.scripts: list[int] = []
        self.open: list[int] = []
        self.in_script, self.silent = False, 0
        self.broken = False
        try:
            self.feed(source)
            self.close()
        except AssertionError:  # the tokenizer's answer to some malformed declarations: what was read counts
            self.broken = True
        self._shut(0, len(source))

    # -- tokens ----------------------------------------------------------------

    def _put(self, entry: int | str, layer: int | None = None) -> None:
        self.stream.append(entry)
        self.layer.append(layer if layer is not None else 2 if self.in_script else int(self.silent > 0))

    def _break(self, tag: str) -> None:
        if tag in BLOCK_TAGS and not self.silent:
            self._put("\n", 3)

    def _offset(self) -> int:
        row, column = self.getpos()
        return self.row_at[row - 1] + column

    def _shut(self, depth: int, offset: int) -> None:
        """Close all open elements from this depth on."""
        while len(self.open) > depth:
            i = self.open.pop()
            self._put(~i)
            self.inner[i], self.cut[i], self.span[i] = len(self.tag), (self.cut[i][0], len(self.stream)), (self.span[i][0], offset)

    def handle_starttag(self, tag, attrs):
        i, at = len(self.tag), self._offset()
        self.silent += tag in SILENT_TAGS
        self._break(tag)
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in attrs})
        self.up.append(self.open[-1] if self.open else -1)
        self.inner.append(i + 1)
        self.cut.append((len(self.stream), 0))
        self.span.append((at, 0))
        self.open.append(i)
        self._put(i)
        self.in_script |= tag == "script"
        if tag in VOID_TAGS:
            self._shut(len(self.open) - 1, at + len(self.get_starttag_text()))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        depth = next((d for d in reversed(range(len(self.open))) if self.tag[self.open[d]] == tag), None)
        if tag == "script":
            self.in_script = False
            self.scripts += [] if depth is None else [self.open[depth]]
        if depth is not None:
            self._shut(depth, self.source.find(">", self._offset()) + 1)
        self._break(tag)
        self.silent = max(0, self.silent - (tag in SILENT_TAGS))

    def handle_data(self, data):
        self._put(data)

    # -- reads -----------------------------------------------------------------

    def shown(self) -> str:
        """The visible text, with line breaks at block tags and the texts that stand for images."""
        out = []
        for x, layer in zip(self.stream, self.layer):
            if isinstance(x, str):
                out += [x] if layer in (0, 3) else []
            elif layer == 0 and x >= 0 and self.tag[x] == "img" and self.attrs[x].get("alt"):
                out.append(f" {self.attrs[x]['alt']} ")
        return "".join(out)

    def words(self) -> str:
        """All visible texts, one blank between."""
        return " ".join(x for x, layer in zip(self.stream, self.layer) if layer == 0 and isinstance(x, str))

    def script_texts(self) -> list[tuple[str, str]]:
        """(attributes in lower case, body) of every closed script."""
        out = []
        for i in self.scripts:
            a, b = self.cut[i]
            out.append((" ".join(f"{k}={v}" for k, v in self.attrs[i].items()).lower(), "".join(x for x in self.stream[a:b] if isinstance(x, str))))
        return out

    def select(self, of: int, rule: str, itself: bool = True) -> list[int]:
        """Elements in ``of`` (-1: the page) that fit a rule.

        ".x": x is among the classes; "*x": the class attribute contains x; "@name=x": an
        attribute is x; "/x": the item type ends with /x; rules joined by blanks must all fit.
        """
        inside = range(len(self.tag)) if of < 0 else range(of + (not itself), self.inner[of])
        return [i for i in inside if self.fits(i, rule)]

    def fits(self, i: int, rule: str) -> bool:
        a = self.attrs[i]
        for r in rule.split():
            kind, x = r[0], r[1:]
            if kind == ".":
                ok = x in a.get("class", "").split()
            elif kind == "*":
                ok = x in a.get("class", "")
            elif kind == "/":
                ok = a.get("itemtype", "").rstrip("/").endswith(r)
            else:
                name, _, value = x.partition("=")
                ok = a.get(name) == value
            if not ok:
                return False
        return True

    def text(self, of: int, without=None) -> str:
        """The text inside an element as cards show it; elements for which ``without`` holds are left out."""
        out, (at, end) = [], self.cut[of]
        while at < end:
            x = self.stream[at]
            if isinstance(x, str):
                out += [x] if self.layer[at] != 3 else []
            elif x >= 0 and (self.tag[x] in CARD_SILENT_TAGS or (without and without(self, x))):
                at = self.cut[x][1]
                continue
            elif self.tag[x if x >= 0 else ~x] in CARD_LINE_TAGS:
                out.append("\n")
            at += 1
        return "".join(out)

    def line(self, of: int) -> str:
        return re.sub(r"\s+", " ", self.text(of)).strip()
