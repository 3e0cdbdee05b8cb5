"""HTML pages as trees of block elements and runs of text, with features of every node."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np

# What elements are for, by the HTML standard.
KINDS = {
    "article": "article",
    "main": "main",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "para": "p blockquote pre figure figcaption dd address details summary",
    "list": "ul ol dl",
    "item": "li dt",
    "table": "table thead tbody tfoot tr td th caption",
    "nav": "nav menu",
    "header": "header",
    "footer": "footer",
    "aside": "aside",
    "form": "form fieldset legend button label output dialog",
}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr nobr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
WITHOUT_NODE = frozenset("html head body".split())
# Contents that are no text of the page; those of the first line run on to the end if never closed.
RAW = frozenset("script style title textarea xmp".split())
SKIPPED = RAW | frozenset(
    "noscript noembed noframes iframe svg math template select object video audio canvas".split()
)
# Optional end tags: what a start tag closes, and where the search for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
}
# Words in names of classes and the like.
TOWARDS = frozenset("article articlebody content main post entry story body text prose".split())
AGAINST = frozenset(
    "nav navigation navbar menu header masthead topbar footer sidebar side aside ad ads advert advertisement "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay share "
    "sharing social related recommended trending comment comments commentlist reply replies respond discussion "
    "disqus form login signup subscribe newsletter search breadcrumb breadcrumbs pagination pager tags widget "
    "toolbar copyright legal skip hidden complementary contentinfo".split()
)

NODE_KINDS = ["root", "div", *KINDS]
LEAF_KINDS = ["text in heading", "text in para", "text in item", "text in table", "text in frame", "text"]
KIND = {name: i for i, name in enumerate([*NODE_KINDS, *LEAF_KINDS])}
KIND_OF_TAG = {tag: KIND[kind] for kind, tags in KINDS.items() for tag in tags.split()}
LEAF_OF_KIND = [KIND["text"]] * len(NODE_KINDS)
for _inside, _kinds in {
    "text in heading": ["heading"],
    "text in para": ["para"],
    "text in item": ["item", "list"],
    "text in table": ["table"],
    "text in frame": ["nav", "header", "footer", "aside", "form"],
}.items():
    for _kind in _kinds:
        LEAF_OF_KIND[KIND[_kind]] = KIND[_inside]

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)>"
    r"|/([a-zA-Z][^\s/>]*)[^>]*>"
    r"|[!?/][^>]*>)",
    re.DOTALL,
)
CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
NAMES = re.compile(
    r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE
)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)
CAMEL = re.compile(r"([a-z])([A-Z])")
LABEL = re.compile(r"data-main=\"([01])\"")
MARKS = ".!?,;:…。、！？"


@lru_cache(50_000)
def sign(attributes: str) -> int:
    """2 if the names speak against main text, 1 if for it, 0 if they say nothing."""
    values = " ".join("".join(found) for found in NAMES.findall(attributes))
    words = set(re.findall("[a-z]+", CAMEL.sub(r"\1 \2", values).lower()))
    if words & AGAINST or HIDDEN.search(attributes):
        return 2
    return 1 if words & TOWARDS else 0


@dataclass
class Trees:
    """Nodes of some pages; a parent comes before its children. ``label``: 1 main text, 0 not."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    sign: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    page: list[int] = field(default_factory=list)  # of leaves, as are texts and leaves
    texts: list[str] = field(default_factory=list)
    leaves: list[int] = field(default_factory=list)

    def node(self, parent: int, kind: int, sign: int, label: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.kind.append(kind)
        self.sign.append(sign)
        self.label.append(label)
        self.length.append(0)
        self.linked.append(0)
        self.marks.append(0)
        return len(self.parent) - 1

    def leaf(self, page: int, parent: int, text: str, linked: int) -> None:
        at = self.node(parent, LEAF_OF_KIND[self.kind[parent]], 0, self.label[parent])
        self.length[at], self.linked[at] = len(text), min(linked, len(text))
        self.marks[at] = sum(map(text.count, MARKS))
        self.page.append(page)
        self.texts.append(text)
        self.leaves.append(at)

    def add(self, page: int, html: str) -> None:
        """Parse a page. Missing end tags are supplied as browsers do; a cut tag at the end goes."""
        stack = [("", self.node(-1, KIND["root"], 0, 0))]
        opened: dict[str, int] = {}
        run: list[str] = []
        never_closed: set[str] = set()
        linked = links = 0
        at = 0

        def flush() -> None:
            nonlocal linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    self.leaf(page, stack[-1][1], text, linked)
                run.clear()
                linked = 0

        def pop_through(tags: set[str]) -> None:
            while True:
                tag, _ = stack.pop()
                opened[tag] -= 1
                if tag in tags:
                    return

        def take(text: str) -> None:
            nonlocal linked
            if text:
                text = unescape(text) if "&" in text else text
                run.append(text)
                if links:
                    linked += len(text)

        while found := TAG.search(html, at):
            take(html[at : found.start()])
            at = found.end()
            name, attributes, end = found.groups()
            if end:
                tag = end.lower()
                if tag == "a":
                    links = 0
                elif opened.get(tag):
                    flush()
                    pop_through({tag})
                elif tag in KIND_OF_TAG or tag == "div":
                    flush()
                continue
            if not name:
                continue
            tag = name.lower()
            if tag in INLINE:
                links = 1 if tag == "a" else links
            elif tag in SKIPPED:
                if tag not in never_closed:
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
                    if close:
                        at = close.end()
                    elif tag in RAW:
                        at = len(html)
                    else:
                        never_closed.add(tag)
            elif tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    run.append(" ")
            elif tag in WITHOUT_NODE:
                flush()
            else:
                flush()
                if stack[-1][0] == "p":
                    pop_through({"p"})
                closes, stops = CLOSES.get(tag, ((), ()))
                for open_tag, _ in reversed(stack):
                    if open_tag in closes:
                        pop_through(closes)
                        break
                    if open_tag in stops or not closes:
                        break
                above = stack[-1][1]
                given = LABEL.search(attributes) if attributes else None
                label = int(given.group(1)) if given else self.label[above]
                kind = KIND_OF_TAG.get(tag, KIND["div"])
                node = self.node(above, kind, sign(attributes) if attributes else 0, label)
                if not attributes.endswith("/") or tag in KIND_OF_TAG:
                    stack.append((tag, node))
                    opened[tag] = opened.get(tag, 0) + 1
        rest = html[at:]
        cut = CUT_TAG.search(rest)
        take(rest[: cut.start()] if cut else rest)
        flush()

    def levels(self) -> list[np.ndarray]:
        """Nodes by depth, roots first."""
        depth = np.array(self.depth, dtype=np.int64)
        order = np.argsort(depth, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []

    def roles(self) -> np.ndarray:
        return np.array(self.kind, dtype=np.int64) * 3 + np.array(self.sign, dtype=np.int64)

    def features(self) -> list[np.ndarray]:
        """For every node a few small numbers: length, share of links, punctuation."""
        parent = np.array(self.parent, dtype=np.int64)
        sums = np.array([self.length, self.linked, self.marks], dtype=np.int64).T
        for level in self.levels()[:0:-1]:
            np.add.at(sums, parent[level], sums[level])
        length, linked, marks = sums.T
        return [
            np.searchsorted([1, 25, 80, 200, 600, 2000], length, side="right"),
            np.searchsorted([0.01, 0.2, 0.5, 0.9], linked / np.maximum(length, 1), side="right"),
            np.searchsorted([1, 120], np.where(marks, length / np.maximum(marks, 1), 0), side="right"),
        ]


SIZES = [7, 5, 3]
