"""Leaf text blocks of HTML pages with their ancestors, from markup of any quality."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

OPEN = re.compile(r"<!--|<!\[CDATA\[|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)|<[!?/]")
HIDDEN = re.compile(r"<!--|<!\[CDATA\[")
QUOTED = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(
    r"""([a-zA-Z_:][a-zA-Z0-9_:.-]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?"""
)
# Element kinds of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset(
    "script style textarea title iframe noembed noframes".split()
)
CLOSES_P = BLOCKS - {"button", "option", "optgroup", "legend", "caption"}
# An element that ends an open one of the same kind, up to the nearest of its containers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = {"table", "td", "th", "button", "caption"}


class Node:
    """An open block element; ``state`` is what a reader of the tree keeps with it."""

    __slots__ = ("entry", "parent", "state")

    def __init__(self, entry: str, parent: Node | None) -> None:
        self.entry, self.parent, self.state = entry, parent, None


class Block(NamedTuple):
    text: str
    node: Node | None  # the nearest ancestor; nodes are shared by the blocks below them
    linked: float  # share of the characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Ancestors, outermost first: "tag" or "tag token token"."""
        out, node = [], self.node
        while node is not None:
            out.append(node.entry)
            node = node.parent
        return tuple(reversed(out))


class Tokens:
    """Tags of a page in order; comments and CDATA sections give no tag.

    A tag ends at the first ``>`` outside quotes or, where quotes do not pair up, at the
    first one. Every scan that fails is remembered, so a page is read in linear time: no tag
    ends after the last ``>``, and a quote from which no end was found is not tried again.
    """

    def __init__(self, page: str) -> None:
        self.page, self.last, self.dead = page, page.rfind(">"), set()

    def attributes(self, at: int) -> str | None:
        """The rest of a tag, quotes paired up; its ``>`` is left out."""
        if not self.dead:
            found = QUOTED.match(self.page, at)
            if found:
                return found[1]
        met, place = [], at
        while (m := SPECIAL.search(self.page, place)) and m.start() not in self.dead:
            if m[0] == ">":
                return self.page[at : m.start()]
            met.append(m.start())
            place = self.page.find(m[0], m.end()) + 1
            if not place:
                break
        self.dead.update(met)
        return None

    def after(self, at: int) -> tuple[int, int, str, bool, str]:
        """(start, end, name, closing, attributes) of the next markup; start -1: no more."""
        page = self.page
        m = (OPEN if at <= self.last else HIDDEN).search(page, at)
        while m:
            if m[0] in ("<!--", "<![CDATA["):
                mark = "-->" if m[0] == "<!--" else "]]>"
                end = page.find(mark, m.end())
                return m.start(), len(page) if end < 0 else end + len(mark), "", False, ""
            if m.end() > self.last:
                m = HIDDEN.search(page, m.start())
                continue
            name = m[2] if m.re is OPEN else None
            if name:
                source = self.attributes(m.end())
                if source is None:
                    source = page[m.end() : page.find(">", m.end())]
                return m.start(), m.end() + len(source) + 1, name.lower(), bool(m[1]), source
            return m.start(), page.find(">", m.end()) + 1, "", False, ""
        return -1, len(page), "", False, ""


def attribute_tokens(source: str) -> str:
    """Lower-case words of class, id, role and hiding attributes."""
    found = []
    for m in ATTRIBUTE.finditer(source):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            found += re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", value).lower())
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.append("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.append("hidden")
    return " ".join(found)


def leaf_blocks(page: str) -> list[Block]:
    """Runs of text between block boundaries, in page order.

    Character references are decoded, white space becomes single spaces, empty runs are
    left out. Scripts, styles and other raw elements hold no text; one without its end tag
    goes on to the end of the page. Formulas, drawings, objects, templates and noscript hold
    text like other inline elements. Missing end tags are implied as in the standard; a line break inside a block counts as white space.
    """
    out: list[Block] = []
    stack: list[tuple[str, Node | None]] = []  # (tag, nearest block element)
    places: dict[str, list[int]] = {}  # of open elements, by tag
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                raw = sum(len(p) for p in pieces)
                out.append(Block(text, stack[-1][1] if stack else None, min(1.0, linked / max(raw, 1))))
            pieces.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        for tag, _ in stack[depth:]:
            places[tag].pop()
        del stack[depth:]

    def last(tags: set[str] | frozenset[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def find(tags: set[str] | frozenset[str], stop: set[str]) -> int:
        depth = last(tags)
        return depth if depth > last(stop) else -1

    tokens, at, end = Tokens(page), 0, len(page)
    while at < end:
        start, after, tag, closing, source = tokens.after(at)
        text = page[at:start] if start >= 0 else page[at:]
        if text:
            pieces.append(text)
            if places.get("a"):
                linked += len(text)
        if start < 0:
            break
        at = after
        if not tag:
            continue
        if closing:
            depth = last({tag})
            if tag in BLOCKS and (depth >= 0 or tag == "p"):
                flush()
            if depth >= 0:
                pop_to(depth)
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag in RAW:
            if not source.endswith("/"):
                # Only up to the last ">": no end tag is complete after it.
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*+>", re.IGNORECASE).search(page, at, tokens.last + 1)
                at = close.end() if close else end
            continue
        if tag in BLOCKS:
            flush()
            if tag in CLOSES_P and (depth := find({"p"}, SCOPE)) >= 0:
                pop_to(depth)
            if tag in ENDS and (depth := find(*ENDS[tag])) >= 0:
                pop_to(depth)
        if tag in VOID:
            if tag != "wbr":
                pieces.append(" ")
            continue
        node = stack[-1][1] if stack else None
        if tag in BLOCKS:
            words = attribute_tokens(source) if source and not source.isspace() else ""
            node = Node(f"{tag} {words}" if words else tag, node)
        places.setdefault(tag, []).append(len(stack))
        stack.append((tag, node))
    flush()
    return out
