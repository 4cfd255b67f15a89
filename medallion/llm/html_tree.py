"""Block elements of a page and the texts in them, as a tree of nodes.

Inline elements belong to the text of their block.  Character references are decoded, white space inside a block
is one space.  Work is linear in the page, whatever its nesting, quoting or truncation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Fixed values of HTML: elements by how they are parsed.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = RAW | frozenset("audio button canvas datalist head math noscript object select svg template video".split())
# An element that ends an open one of these, up to a boundary.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "option": (("option",), ("select",))}

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?/])")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_EDGE = re.compile(r"""["'>]""")
_BLANK = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    parent: int
    tag: str                      # "" for a text
    depth: int
    names: tuple[str, ...] = ()   # words of class, id and role
    mark: str = ""                # of pages made for training
    text: str = ""
    chars: int = 0
    linked: int = 0               # characters inside links
    texts: int = 0
    children: int = 0


def names(attributes: str) -> tuple[str, ...]:
    """Lower-case words of class, id and role; compound names are cut at signs and at capitals."""
    held = " ".join("".join(m) for m in _NAMES.findall(attributes))
    return tuple(dict.fromkeys(w.lower() for w in _TOKEN.findall(held)))


class _Scan:
    def __init__(self, html: str):
        self.html, self.nodes = html, [Node(-1, "#page", 0)]
        self.stack, self.count = [0], {}
        self.pieces: list[str] = []
        self.own = self.in_link = 0       # characters of the block so far, those inside links
        self.link = self.unseen = 0       # depth of links and of elements that are never shown
        self.last: dict[str, int] = {}    # where a sign is known not to come again

    def find(self, sign: str, at: int) -> int:
        if at >= self.last.get(sign, len(self.html) + 1):
            return -1
        found = self.html.find(sign, at)
        if found < 0:
            self.last[sign] = at
        return found

    def flush(self) -> None:
        """End the block's text."""
        if self.pieces:
            text = _BLANK.sub(" ", unescape("".join(self.pieces))).strip()
            self.pieces = []
            if text:
                share = self.in_link / max(self.own, 1)
                top = self.nodes[self.stack[-1]]
                top.children += 1
                self.nodes.append(Node(self.stack[-1], "", top.depth + 1, text=text, chars=len(text), linked=round(share * len(text)), texts=1))
        self.own = self.in_link = 0

    def words(self, text: str) -> None:
        if text and not self.unseen:
            self.pieces.append(text)
            n = len(text) if not text.isspace() else 0
            self.own += n
            self.in_link += n if self.link else 0

    def push(self, tag: str, attributes: str) -> None:
        self.flush()
        top = self.stack[-1]
        self.nodes[top].children += 1
        mark = attributes.rpartition("data-mark=")[2][:1] if "data-mark=" in attributes else ""
        self.nodes.append(Node(top, tag, self.nodes[top].depth + 1, names(attributes) if "=" in attributes else (), mark))
        self.stack.append(len(self.nodes) - 1)
        self.count[tag] = self.count.get(tag, 0) + 1
        self.unseen += tag in UNSEEN

    def pop(self) -> None:
        self.flush()
        tag = self.nodes[self.stack.pop()].tag
        self.count[tag] -= 1
        self.unseen -= tag in UNSEEN
        self.link = 0

    def close(self, tags: tuple[str, ...], limits: tuple[str, ...] = ()) -> None:
        """Pop up to an open element of ``tags`` that no open one of ``limits`` hides."""
        if any(self.count.get(t) for t in tags):
            for n in range(len(self.stack) - 1, 0, -1):
                tag = self.nodes[self.stack[n]].tag
                if tag in limits:
                    return
                if tag in tags:
                    while len(self.stack) > n:
                        self.pop()
                    return

    def tag_end(self, at: int) -> int:
        """The > of a tag, which may not stand in a quoted value."""
        while (found := _EDGE.search(self.html, at)) is not None:
            if found[0] == ">":
                return found.start()
            other = self.find(found[0], found.end())
            if other < 0:  # a quote that never ends does not hide the rest of the page
                end = self.find(">", found.end())
                return len(self.html) if end < 0 else end
            at = other + 1
        return len(self.html)

    def run(self) -> list[Node]:
        html, at = self.html, 0
        while (found := _OPEN.search(html, at)) is not None:
            self.words(html[at:found.start()])
            at = found.end()
            tag = found[2]
            if tag is None:  # comments and declarations
                end = self.find("-->", at) if found[0] == "<!--" else self.find(">", at)
                at = len(html) if end < 0 else end + (3 if found[0] == "<!--" else 1)
                continue
            tag, end = tag.lower(), self.tag_end(at)
            attributes, at = html[at:end], end + 1
            if tag in INLINE:
                if tag == "br":
                    self.words(" ")
                elif tag == "a":
                    self.link = 0 if found[1] else 1
            elif found[1]:
                self.close((tag,))
            else:
                if self.nodes[self.stack[-1]].tag == "p":
                    self.pop()
                elif tag in ENDS:
                    self.close(*ENDS[tag])
                if tag in VOID or attributes.endswith("/") and tag not in RAW and tag not in ("p", "div", "section", "article"):
                    self.flush()
                    continue
                self.push(tag, attributes)
                if tag in RAW:
                    done = re.compile(f"</{tag}", re.I).search(html, at)
                    at = done.start() if done else len(html)
        self.words(html[at:])
        while self.stack:
            if len(self.stack) == 1:
                self.flush()
                break
            self.pop()
        for node in reversed(self.nodes[1:]):
            up = self.nodes[node.parent]
            up.chars += node.chars
            up.linked += node.linked
            up.texts += node.texts
        return self.nodes


def parse(html: str | None) -> list[Node]:
    """Nodes in page order, the page first; a parent comes before its children."""
    return _Scan(html or "").run()
