"""HTML to trees of nodes: elements and runs of text, in page order, without recursion.

A small tree builder in the manner of browsers: void elements, raw-text elements, end tags that are
implied, character references. Every page costs time in proportion to its length, however broken it is.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TEXT = "#text"
# Names of HTML elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
MUTE = frozenset("template svg math select datalist object canvas audio video head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("title meta link base style script noscript template".split())
SCOPES = frozenset("table td th caption button html".split())
# A start tag on the left ends the nearest open element on the right, if no element in between keeps it.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr"}, {"table"}),
    "tfoot": ({"tbody", "tr"}, {"table"}),
}
# A quote counts after an equals sign only, and where it is closed.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HINTS = ("class", "id", "role", "itemprop", "aria-label")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.IGNORECASE) for name in RAW}


# Deeper elements count as parts of the one at this depth, as in browsers.
DEEPEST = 512


@dataclass
class Tree:
    """Nodes in page order: a node's parent comes before it. ``pieces`` is the text in page order, as
    numbers of text nodes and, where there is white space or a block's edge, -1."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    linked: list[bool] = field(default_factory=lambda: [False])
    text: list[str] = field(default_factory=lambda: [""])
    hints: dict[int, tuple[str, ...]] = field(default_factory=dict)
    marks: dict[int, str] = field(default_factory=dict)
    pieces: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, linked: bool, text: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.linked.append(linked)
        self.text.append(text)
        return len(self.tag) - 1


def _hints(attributes: dict[str, str]) -> tuple[str, ...]:
    found = (word.lower() for name in HINTS for word in _WORD.findall(attributes.get(name, "")) if len(word) > 1)
    return tuple(dict.fromkeys(found))


class _Builder:
    def __init__(self, mark: str | None):
        self.tree, self.mark = Tree(), mark
        self.nodes, self.names = [0], ["html"]
        self.open = {"html": 1}  # how many elements of a name are open
        self.beyond: dict[str, int] = {}  # of these, those too deep to be on the stack
        self.muted = 0

    def pop(self) -> None:
        self.nodes.pop()
        name = self.names.pop()
        self.open[name] -= 1
        self.muted -= name in MUTE

    def close(self, wanted, keeps) -> bool:
        """Close the nearest open element named in ``wanted``, unless one in ``keeps`` is nearer."""
        if any(self.open.get(name) for name in wanted):
            for i in range(len(self.names) - 1, 0, -1):
                if self.names[i] in wanted:
                    while len(self.names) > i:
                        self.pop()
                    return True
                if self.names[i] in keeps:
                    break
        return False

    def close_inline(self, name: str) -> None:
        """Close the nearest ``name``, unless a block was opened since."""
        for i in range(len(self.names) - 1, 0, -1):
            if self.names[i] == name:
                while len(self.names) > i:
                    self.pop()
            if i >= len(self.names) or self.names[i] not in INLINE:
                break

    def text(self, text: str) -> None:
        if not text:
            return
        if self.names[-1] == "head" and not text.isspace():
            self.pop()
        if not self.muted:
            text = html.unescape(text) if "&" in text else text
            # White space parts words, but there is nothing to decide about it.
            made = -1 if text.isspace() else self.tree.add(TEXT, self.nodes[-1], bool(self.open.get("a")), text)
            self.tree.pieces.append(made)

    def end(self, name: str) -> None:
        if name in HEADINGS:  # any of them ends any
            self.close(HEADINGS, SCOPES)
            return
        if not self.open.get(name) or name == "html":
            return
        if self.beyond.get(name):
            self.beyond[name] -= 1
            self.open[name] -= 1
            self.muted -= name in MUTE
        elif name in INLINE:
            self.close_inline(name)
        else:
            self.close((name,), () if name in SCOPES else SCOPES)

    def start(self, name: str, inside: str) -> None:
        if self.names[-1] == "head" and name not in IN_HEAD:
            self.pop()
        if name in _ENDS:
            while self.close(*_ENDS[name]):
                pass
        elif name not in INLINE and name not in VOID and name not in RAW:
            self.close(("p",), SCOPES)
        if name in VOID or name in RAW or (name in ("html", "body") and self.open.get(name)):
            return
        attributes: dict[str, str] = {}
        if "=" in inside:
            for key, *values in _ATTRIBUTE.findall(inside):
                attributes.setdefault(key.lower(), values[0] or values[1] or values[2])
        self.open[name] = self.open.get(name, 0) + 1
        self.muted += name in MUTE
        node = self.tree.add(name, self.nodes[-1], bool(self.open.get("a")))
        if attributes and (found := _hints(attributes)):
            self.tree.hints[node] = found
        if self.mark is not None and self.mark in attributes:
            self.tree.marks[node] = attributes[self.mark]
        if len(self.nodes) < DEEPEST:
            self.nodes.append(node)
            self.names.append(name)
        else:
            self.beyond[name] = self.beyond.get(name, 0) + 1


def parse(page: str, mark: str | None = None) -> Tree:
    """The tree of ``page``. ``mark`` names an attribute whose values go to ``marks``."""
    builder = _Builder(mark)
    at, size = 0, len(page)
    while at < size:
        opened = page.find("<", at)
        if opened < 0:
            builder.text(page[at:])
            break
        tag = _TAG.match(page, opened)
        if tag is not None:
            builder.text(page[at:opened])
            at, name = tag.end(), tag[2].lower()
            if name not in INLINE:
                builder.tree.pieces.append(-1)
            if tag[1]:
                builder.end(name)
                continue
            builder.start(name, tag[3])
            if name in RAW:
                closed = _RAW_END[name].search(page, at)
                at = closed.end() if closed else size
            continue
        following = page[opened + 1 : opened + 2]
        if following.isascii() and (following.isalpha() or following in ("!", "?", "/")):
            builder.text(page[at:opened])
            if following.isalpha():
                break  # the page ends inside a tag
            ends = "-->" if page.startswith("<!--", opened) else ">"
            closed = page.find(ends, opened + (2 if ends == "-->" else 1))  # "<!-->" is whole
            at = closed + len(ends) if closed >= 0 else size
        else:  # a sign, not a tag
            after = page.find("<", opened + 1)
            after = after if after >= 0 else size
            builder.text(page[at:after])
            at = after
    return builder.tree


def joined(tree: Tree, chosen) -> str:
    """The chosen text nodes in page order: white space in a block is one space, blocks are joined by one."""
    return " ".join("".join(" " if i < 0 else tree.text[i] if chosen[i] else "" for i in tree.pieces).split())
