"""A small HTML tree with the selectors that directory pages need. Plain Python, no Spark."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
#: Open elements that a start tag ends, and elements that stop the search for them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
P_SCOPE = frozenset("td th li dd div section article body button".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def nodes(self) -> Iterator[Node]:
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def all(self, *tags: str, having: Callable[[Node], bool] | None = None) -> list[Node]:
        return [n for n in self.nodes() if (not tags or n.tag in tags) and (having is None or having(n))]

    def first(self, *tags: str, having: Callable[[Node], bool] | None = None) -> Node | None:
        return next((n for n in self.nodes() if (not tags or n.tag in tags) and (having is None or having(n))), None)

    def select(self, selector: str) -> list[Node]:
        wanted = compiled(selector)
        return [n for n in self.nodes() if any(_fits(n, chain, self) for chain in wanted)]

    def one(self, selector: str) -> Node | None:
        wanted = compiled(selector)
        return next((n for n in self.nodes() if any(_fits(n, chain, self) for chain in wanted)), None)

    def text(self, between: str = "") -> str:
        """Strings below in order; those of scripts and styles only if this is one."""
        out: list[str] = []
        todo: list[Node | str] = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in RAW:
                todo += reversed(x.children)
        return between.join(out)

    def get(self, name: str) -> str | None:
        return self.attrs.get(name)

    def next_element(self) -> Node | None:
        if self.parent is None:
            return None
        after = self.parent.children[self.parent.children.index(self) + 1 :]
        return next((x for x in after if isinstance(x, Node)), None)

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [x for x in self.parent.children if x is not self]
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.at = self.root

    def _close(self, tags: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> None:
        node, last = self.at, None
        while node is not self.root and node.tag not in stop:
            if node.tag in tags:
                last = node
            node = node.parent  # type: ignore[assignment]
        if last is not None:
            self.at = last.parent  # type: ignore[assignment]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS:
            self._close(*ENDS[tag])
        if tag in BLOCKS:
            self._close({"p"}, P_SCOPE)
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not self.root:
            if node.tag == tag:
                self.at = node.parent  # type: ignore[assignment]
                return
            node = node.parent  # type: ignore[assignment]

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; broken markup gives what can be read."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


# ---- selectors: tag, .class, #id, [a], [a=v], [a^=v], [a*=v], [a$=v], an i flag, descendants, lists

_PART = re.compile(r"""\.([\w-]+)|\#([\w-]+)|\[\s*([\w-]+)\s*(?:([~^*$]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*([iI])?\s*)?\]|([\w-]+|\*)""")
Test = Callable[[Node], bool]


def _test(m: re.Match[str]) -> Test:
    if m[1]:
        return lambda n, v=m[1]: v in n.attrs.get("class", "").split()
    if m[2]:
        return lambda n, v=m[2]: n.attrs.get("id") == v
    if m[3]:
        name, how, value, fold = m[3], m[4], m[5] or m[6] or m[7] or "", bool(m[8])

        def holds(n: Node) -> bool:
            own = n.attrs.get(name)
            if own is None or how is None:
                return own is not None
            a, b = (own.lower(), value.lower()) if fold else (own, value)
            return {"=": a == b, "^=": bool(b) and a.startswith(b), "*=": bool(b) and b in a, "$=": bool(b) and a.endswith(b), "~=": b in a.split()}[how]

        return holds
    return lambda n, v=m[9].lower(): v == "*" or n.tag == v


@lru_cache(maxsize=512)
def compiled(selector: str) -> tuple[tuple[tuple[Test, ...], ...], ...]:
    """For each alternative, its compound selectors from the outermost in."""
    out = []
    for alternative in _split(selector, ","):
        out.append(tuple(tuple(_test(m) for m in _PART.finditer(part)) for part in _split(alternative.strip(), " ")))
    return tuple(out)


def _split(selector: str, mark: str) -> list[str]:
    """Pieces between marks that stand outside brackets."""
    out, depth = [""], 0
    for c in selector:
        depth += (c == "[") - (c == "]")
        if c == mark and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x for x in out if x.strip()]


def _fits(node: Node, chain: tuple[tuple[Test, ...], ...], top: Node) -> bool:
    *outer, own = chain
    if not all(t(node) for t in own):
        return False
    above = node.parent
    for part in reversed(outer):
        while above is not None and not all(t(above) for t in part):
            above = above.parent
        if above is None:
            return False
        above = above.parent
    return True
