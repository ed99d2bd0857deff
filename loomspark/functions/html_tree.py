"""A small HTML tree on the standard library's parser, lenient in the way its callers rely on.

An unclosed tag stays open; an end tag closes up to the nearest open tag of its name and is ignored if there is none; void tags
have no children.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
WS = re.compile(r"\s+")


class Node:
    """An element; the document is one named ``#document``. Children are nodes, texts (str) or notes (comment, doctype)."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order; children may be changed behind the walk."""
        for child in list(self.children):
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def texts(self) -> Iterator[str]:
        for child in self.children:
            if isinstance(child, Node):
                yield from child.texts()
            elif isinstance(child, str):
                yield child

    def text(self, joiner: str = "", strip: bool = False) -> str:
        parts = (t.strip() if strip else t for t in self.texts())
        return joiner.join(p for p in parts if p or not strip)

    def find(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)

    def all(self, test: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if test(n)]

    def at(self) -> int:
        return next(i for i, c in enumerate(self.parent.children) if c is self)

    def drop(self) -> None:
        if self.parent is not None:
            del self.parent.children[self.at()]
            self.parent = None

    def replace(self, *new) -> None:
        i = self.at()
        for n in new:
            if isinstance(n, Node):
                n.parent = self.parent
        self.parent.children[i : i + 1] = new
        self.parent = None

    def unwrap(self) -> None:
        self.replace(*self.children)
        self.children = []

    def inside(self, other: Node) -> bool:
        n = self.parent
        while n is not None and n is not other:
            n = n.parent
        return n is not None


class Note:
    """A comment or a declaration."""

    __slots__ = ("markup",)

    def __init__(self, markup: str):
        self.markup = markup


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("#document")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        n = self.now
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.now = n.parent

    def handle_data(self, data):
        kids = self.now.children
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)

    def handle_comment(self, data):
        self.now.children.append(Note(f"<!--{data}-->"))

    def handle_decl(self, decl):
        self.now.children.append(Note(f"<!{decl}>"))

    def handle_pi(self, data):
        self.now.children.append(Note(f"<?{data}>"))

    def unknown_decl(self, data):
        self.now.children.append(Note(f"<![{data}]>"))


def parse(text: str) -> Node:
    b = _Builder()
    b.feed(text)
    b.close()
    return b.root


def _open(n: Node) -> str:
    attrs = "".join(f' {k}="{html.escape(v, quote=False).replace(chr(34), "&quot;")}"' for k, v in n.attrs.items())
    return f"<{n.tag}{attrs}{'/' if n.tag in VOID else ''}>"


def markup(n) -> str:
    """The tree as one string."""
    if isinstance(n, str):
        return html.escape(n, quote=False)
    if isinstance(n, Note):
        return n.markup
    inner = "".join(markup(c) for c in n.children)
    if n.tag == "#document":
        return inner
    return _open(n) + ("" if n.tag in VOID else f"{inner}</{n.tag}>")


def prettify(n: Node) -> str:
    """One tag or text a line, a space for each level of depth, blank text left out; what stands in pre is kept as it is."""
    out: list[str] = []

    def put(x, depth: int) -> None:
        pad = " " * depth
        if isinstance(x, str):
            if x.strip():
                out.append(pad + html.escape(x.strip(), quote=False))
        elif isinstance(x, Note):
            out.append(pad + x.markup)
        elif x.tag in ("pre", "textarea"):
            out.append(pad + markup(x))
        else:
            out.append(pad + _open(x))
            if x.tag not in VOID:
                for c in x.children:
                    put(c, depth + 1)
                out.append(f"{pad}</{x.tag}>")

    for c in n.children if n.tag == "#document" else [n]:
        put(c, 0)
    return "\n".join(out) + "\n" if out else ""


def merge_texts(n: Node, join: Callable[[str, str], str] = str.__add__) -> None:
    """Neighbouring texts become one, here and below."""
    kids: list = []
    for c in n.children:
        if isinstance(c, str) and kids and isinstance(kids[-1], str):
            kids[-1] = join(kids[-1], c)
        else:
            kids.append(c)
            if isinstance(c, Node):
                merge_texts(c, join)
    n.children = kids
