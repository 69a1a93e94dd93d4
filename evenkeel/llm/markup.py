"""A page as a tree of its block elements and of the runs of text between them."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

TAG = re.compile(
    r"<(?:!--(.*?)(?:--!?>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|[!?/][^>]*+(?:>|\Z))", re.S)
BROKEN = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")  # a tag that the end of the page cuts off
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PIECE = re.compile(r"[a-z]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What these hold is never text of a page.
UNSEEN = frozenset("script style noscript template title textarea iframe svg select".split())
ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in UNSEEN}
# A start tag on the left ends an open element on the right that it stands directly in.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "body": {"head"},
}


@dataclass
class Page:
    """Nodes in page order, parents first; a node is an element or a run of text."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    names: list[list[str]] = field(default_factory=lambda: [[]])  # words of class, id and role
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[int] = field(default_factory=lambda: [0])  # characters within links
    marked: list[bool] = field(default_factory=lambda: [False])  # between content marks
    links: int = 0
    title: str = ""


def parse(source: str | None, marks: bool = False) -> Page:
    """Reads a page; with ``marks``, comments ``main`` and ``/main`` enclose its content."""
    page = Page()
    if not source:
        return page
    stack, run, linked, in_link, inside = [0], [], 0, False, False
    opened = Counter()  # elements on the stack by tag
    position, end = 0, len(source)

    def node(parent: int, tag: str, names: list[str], text: str, in_links: int) -> int:
        page.parent.append(parent)
        page.tag.append(tag)
        page.names.append(names)
        page.text.append(text)
        page.linked.append(in_links)
        page.marked.append(inside)
        return len(page.tag) - 1

    def leave() -> str:
        tag = page.tag[stack.pop()]
        opened[tag] -= 1
        return tag

    def flush() -> None:
        nonlocal linked
        if run:
            if text := " ".join("".join(run).split()):
                node(stack[-1], "#text", [], text, linked)
            run.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = html.unescape(text)
        run.append(text)
        if in_link:
            linked += len(text)

    while position < end:
        match = TAG.search(source, position)
        if match is None:
            rest = source[position:]
            broken = BROKEN.search(rest)
            say(rest[:broken.start()] if broken else rest)
            break
        if match.start() > position:
            say(source[position:match.start()])
        position = match.end()
        comment, closing, tag, attributes = match.groups()
        if tag is None:
            if marks and comment in ("main", "/main"):
                flush()
                inside = comment == "main"
            continue
        tag = tag.lower()
        if closing:
            if tag in INLINE:
                in_link = in_link and tag != "a"
                continue
            flush()
            in_link = False
            if opened[tag]:
                while leave() != tag:
                    pass
            continue
        if tag in UNSEEN:
            stop = ENDS[tag].search(source, position)
            if tag == "title" and not page.title:
                page.title = " ".join(html.unescape(
                    source[position:stop.start() if stop else end]).split())
            position = stop.end() if stop else end
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = True
                page.links += 1
            elif tag == "br":
                run.append(" ")
            continue
        flush()
        in_link = False
        if page.tag[stack[-1]] == "p":  # a paragraph holds no block
            leave()
        while len(stack) > 1 and page.tag[stack[-1]] in CLOSES.get(tag, ()):
            leave()
        names = []
        if "=" in attributes:
            for found in ATTRIBUTE.findall(attributes):
                names += PIECE.findall("".join(found).lower())
        made = node(stack[-1], tag, names, "", 0)
        if tag not in VOID:
            stack.append(made)
            opened[tag] += 1
    flush()
    return page


def plain_text(source: str | None) -> tuple[Page, str]:
    """The page and all of its visible text, one line for each block."""
    page = parse(source)
    return page, "\n".join(t for t in page.text if t)
