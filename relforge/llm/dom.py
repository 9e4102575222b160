"""A small DOM for main-text extraction: elements and texts of a page in document order."""

from __future__ import annotations

import re
from html import unescape

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+|[0-9]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SECTIONS = frozenset("article main nav aside header footer form section".split())
#: never shown as text of a page
MUTE = frozenset("head script style noscript template textarea title select option button svg math iframe object canvas audio video datalist xmp noembed noframes".split())
_CLOSES = {  # an opening tag -> open elements that it ends, and the elements it doesn't look beyond
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
_SCOPE = frozenset("table td th caption button object html".split())


class Page:
    """Parallel lists over nodes in document order; a text is a node with tag ``#``."""

    __slots__ = ("attrs", "end", "parent", "tag", "text")

    def __init__(self) -> None:
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.attrs: list[str] = [""]
        self.text: list[str] = [""]
        self.end: list[int] = []  # last node below each node

    def add(self, tag: str, parent: int, attrs: str = "", text: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        self.text.append(text)
        return len(self.tag) - 1


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def tokens(attrs: dict[str, str]) -> list[str]:
    """Words of class, id and role, in lower case, camel case split."""
    named = " ".join(attrs.get(k, "") for k in ("class", "id", "role"))
    return _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower()) if named.strip() else []


def parse(html: str) -> Page:
    page, stack, at, n = Page(), [0], 0, len(html)
    tags = page.tag

    def words(raw: str) -> None:
        if raw:
            page.add("#", stack[-1], text=unescape(raw) if "&" in raw else raw)

    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            words(html[at:])
            break
        words(html[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA["):
                words(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if m[1]:
            if any(tags[i] == name for i in reversed(stack)):
                while tags[stack.pop()] != name:
                    pass
                stack = stack or [0]
            elif name in ("br", "p"):
                page.add(name, stack[-1])
            continue
        if name not in INLINE and name not in VOID | {"html", "body", "head"} or name == "hr":
            for depth in range(len(stack) - 1, 0, -1):  # an open paragraph ends at a block
                if tags[stack[depth]] == "p":
                    del stack[depth:]
                    break
                if tags[stack[depth]] in _SCOPE:
                    break
        if name in _CLOSES:
            ends, scope = _CLOSES[name]
            found = None
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] in scope:
                    break
                if tags[stack[depth]] in ends:
                    found = depth
            if found:
                del stack[found:]
        node = page.add(name, stack[-1], m[3])
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(html, at)
            at = n if close is None else html.find(">", close.start()) + 1 or n
        elif name not in VOID and not m[3].endswith("/"):
            stack.append(node)
        elif name not in VOID:  # <div/> opens a div all the same
            stack.append(node)
    size = len(tags)
    page.end = list(range(size))
    for i in range(size - 1, 0, -1):
        p = page.parent[i]
        if page.end[i] > page.end[p]:
            page.end[p] = page.end[i]
    return page
