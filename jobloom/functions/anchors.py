"""Anchors of HTML, with the text around them; the parser is the standard library's."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Node:
    __slots__ = ("tag", "href", "parent", "children")

    def __init__(self, tag, href=None, parent=None):
        self.tag, self.href, self.parent, self.children = tag, href, parent, []


class _Tree(HTMLParser):
    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.top = self.now = _Node("")
        self.anchors: list[_Node] = []
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(reversed(attrs)).get("href", None) if tag == "a" else None, self.now)
        has_href = tag == "a" and any(name == "href" for name, _ in attrs)
        self.now.children.append(node)
        if has_href:
            node.href = next(value for name, value in reversed(attrs) if name == "href") or ""
            self.anchors.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.now
        while node is not self.top and node.tag != tag:
            node = node.parent
        if node is not self.top:
            self.now = node.parent

    def handle_data(self, data):
        self.now.children.append(data)


def _text(node) -> str:
    if isinstance(node, str):
        return re.sub(r"\s+", " ", node).strip()
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x.strip())
        elif x.tag not in ("script", "style", "template"):
            todo += reversed(x.children)
    return re.sub(r"\s+", " ", " ".join(s for s in out if s)).strip()


def anchors(source: str | None) -> list[tuple[int, str, str, str, str | None]]:
    """(pos, href, text, parent's text, summary) of every anchor with an href, in document order.
    The summary is the text of the parent and the three nodes after it, without the anchor's own at its start."""
    out = []
    for pos, a in enumerate(_Tree(source or "").anchors):
        title, parent = _text(a), a.parent
        around = [_text(parent)]
        if parent.parent is not None:
            siblings = parent.parent.children
            at = next(i for i, x in enumerate(siblings) if x is parent)
            around += map(_text, siblings[at + 1 : at + 4])
        merged = " ".join(s for s in around if s)
        if merged.startswith(title):
            merged = merged[len(title) :].strip()
        out.append((pos, a.href, title, around[0], merged or None))
    return out


def extract_anchors(source: Column) -> Column:
    """Array of struct(pos, href, anchor_text, parent_text, summary)."""
    return F.udf(anchors, "array<struct<pos:int,href:string,anchor_text:string,parent_text:string,summary:string>>", useArrow=True)(source)
