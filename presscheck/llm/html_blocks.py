"""The text blocks of a web page, with the elements that hold them.

A block is the text between two tags that are not inline. White space in it, and ``br``, is
one space; character references are decoded; scripts, styles and the like are no text. The
tags that are never closed, or closed twice, are read as browsers do: by what may hold what.
Plain functions on one page; the time is linear in the page.
"""

from __future__ import annotations

import html
import re

# Elements that do not end a block, that hold no text for readers, that close
# their like, and that name a part of the page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style noscript textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr",),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr"),
}
HOLDS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",),
    "td": ("tr", "table"), "th": ("tr", "table"), "tbody": ("table",),
}
LANDMARKS = frozenset("article main nav header footer aside form section".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:[!?]|/(?![A-Za-z]))[^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Elements whose features are kept from page to page.
_PLACES = 20_000


class Place:
    """Where a block stands: the features of all elements around it, and what a model makes of them."""

    __slots__ = ("around", "features", "landmarks", "score", "main")

    def __init__(self, around, features, landmarks, score, main):
        self.around, self.features, self.landmarks, self.score, self.main = around, features, landmarks, score, main


class Reader:
    """Reads pages into blocks. ``weights`` scores places; without it, places keep all features."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights
        self.clear()

    def clear(self) -> None:
        self.top = Place(frozenset(), frozenset(), ("", ""), 0.0, None)
        self.inside: dict[tuple, Place] = {}

    def place(self, parent: Place, name: str, attributes: str) -> Place:
        key = (id(parent), name, attributes)
        found = self.inside.get(key)
        if found is None:
            found = self.inside[key] = self._place(parent, name, attributes)
        return found

    def _place(self, parent: Place, name: str, attributes: str) -> Place:
        around = {f"in {name}"}
        if name in ("html", "body"):
            around = set()
        else:
            for names in _NAMES.finditer(attributes):
                for word in _WORD.findall(names[1] or names[2] or names[3] or ""):
                    # Words of one stem share a feature.
                    around.update((f"named {word.lower()}", f"named {word.lower()[:5]}*"))
            if attributes and _HIDDEN.search(attributes):
                around.add("hidden")
        landmarks = (name, parent.landmarks[0]) if name in LANDMARKS else parent.landmarks
        if self.weights is not None:
            around = {f for f in around if f in self.weights}
        around = parent.around | around
        own = {f"as {name}", f"part {landmarks[0]} of {landmarks[1]}"}
        features = around | own
        score = sum(self.weights.get(f, 0.0) for f in features) if self.weights is not None else 0.0
        said = re.search(r'data-main="(yes|no)"', attributes) if self.weights is None else None
        return Place(around, features, landmarks, score, said[1] == "yes" if said else parent.main)

    def read(self, page: str | None) -> list[tuple[Place, str, int]]:
        """Place, text and number of its characters in links, for each block with text."""
        if not page:
            return []
        if len(self.inside) > _PLACES:
            self.clear()
        blocks: list[tuple[Place, str, int]] = []
        stack: list[tuple[str, Place]] = []
        count: dict[str, int] = {}
        parts: list[str] = []
        # A link ends with the element that it began in, at the latest.
        place, linked, link_depth = self.top, 0, None
        at, end, skip = 0, len(page), None

        def flush():
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    blocks.append((place, text, min(linked, len(text))))
                parts.clear()
            linked = 0

        def pop_to(name):
            nonlocal place, link_depth
            while stack:
                top, _ = stack.pop()
                count[top] -= 1
                if top == name:
                    break
            place = stack[-1][1] if stack else self.top
            if link_depth is not None and len(stack) < link_depth:
                link_depth = None

        while at < end:
            tag = _TAG.search(page, at)
            stop = tag.start() if tag else end
            if stop > at and not skip:
                text = page[at:stop]
                if "&" in text:
                    text = html.unescape(text)
                parts.append(text)
                if link_depth is not None:
                    linked += len(text)
            if not tag:
                break
            at = tag.end()
            name = (tag[2] or "").lower()
            if not name:
                continue
            closing = bool(tag[1])
            if skip:
                if name == "template":
                    skip += -1 if closing else 1
                continue
            if name in RAW:
                if not closing:
                    close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
                    at = close.start() if close else end
                continue
            if name == "template":
                skip = 0 if closing else 1
                continue
            if name in INLINE:
                if name == "a":
                    link_depth = None if closing else len(stack)
                continue
            if name == "br":
                parts.append(" ")
                continue
            flush()
            if closing:
                if count.get(name):
                    pop_to(name)
                continue
            if count.get("p"):
                # A paragraph holds no block, unless something in it began anew.
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop_to("p")
                        break
                    if stack[i][0] in ("td", "th", "li", "div", "article", "section", "form"):
                        break
            for other in CLOSES.get(name, ()):
                if count.get(other):
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == other:
                            pop_to(other)
                            break
                        if stack[i][0] in HOLDS[name]:
                            break
            if name in VOID:
                continue
            place = self.place(place, name, tag[3])
            stack.append((name, place))
            count[name] = count.get(name, 0) + 1
        flush()
        return blocks
