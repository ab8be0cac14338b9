"""Element trees of raw, often broken pages, and their alignment by simple tree matching."""

from __future__ import annotations

import re
from html import unescape

import xxhash

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: Kinds of elements by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPAQUE = frozenset("script style textarea title noscript iframe noembed noframes template svg math xmp object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table tbody thead tfoot body html".split())  # an implied end doesn't reach beyond


class Node:
    __slots__ = ("tag", "names", "hidden", "parts", "parent", "_size", "_text")

    def __init__(self, tag: str, names: str = "", hidden: bool = False, parent: Node | None = None):
        self.tag, self.names, self.hidden, self.parent = tag, names, hidden, parent
        self.parts: list[Node | str] = []  # text and elements in order
        self._size = self._text = None

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag

    @property
    def children(self) -> list[Node]:
        return [x for x in self.parts if not isinstance(x, str)]

    @property
    def text(self) -> str:
        if self._text is None:
            self._text = " ".join("".join(x if isinstance(x, str) else x.text if x.tag in INLINE else f" {x.text} " for x in self.parts).split())
        return self._text

    @property
    def size(self) -> int:
        if self._size is None:
            self._size = 1 + sum(x.size for x in self.children)
        return self._size

    def path(self) -> str:
        return self.label if self.parent is None else f"{self.parent.path()}/{self.label}"


def parse(html: str) -> Node:
    """The tree of a page. Unclosed elements end with their parents; what scripts and the like hold is left out."""
    root = here = Node("html")
    at, depth = 0, 0
    while m := TOKEN.search(html, at):
        if m.start() > at:
            here.parts.append(unescape(html[at:m.start()]))
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            up = here
            while up.parent is not None and up.tag != tag and not (up.tag not in INLINE and (tag in INLINE or tag == "p" and up.tag != "p")):
                up = up.parent
            if up.parent is not None and up.tag == tag:
                while here is not up:
                    here, depth = here.parent, depth - 1
                here, depth = up.parent, depth - 1
            continue
        if tag in ("html", "body"):
            continue
        found = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(m["rest"])}
        names = " ".join(x for x in (found.get("class", ""), found.get("id", ""), found.get("role", "")) if x).lower()
        hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
        if tag in OPAQUE:
            if not m["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in VOID:
            here.parts.append(" " if tag in ("br", "hr") else "")
            continue
        if tag not in INLINE or tag in CLOSED_BY:  # a block ends an open paragraph, a list item the one before
            up = here
            while up.parent is not None and up.tag in INLINE:
                up = up.parent
            if up.tag == "p" and up.parent is not None:
                while here is not up:
                    here, depth = here.parent, depth - 1
                here, depth = up.parent, depth - 1
            up, ends = here, CLOSED_BY.get(tag, ())
            while ends and up.parent is not None and up.tag not in ends and up.tag not in HOLDS:
                up = up.parent
            if up.tag in ends and up.parent is not None:
                while here is not up:
                    here, depth = here.parent, depth - 1
                here, depth = up.parent, depth - 1
        node = Node(tag, names, hidden, here)
        here.parts.append(node)
        if depth < MOST_DEEP and not m["rest"].endswith("/"):
            here, depth = node, depth + 1
    here.parts.append(unescape(html[at:]))
    return root


MOST_DEEP = 200  # elements nested deeper lie side by side: no text is lost, and recursion is bounded
MOST_PAIRS = 40_000  # cells of a table that is held as a whole; longer lists of siblings are halved until theirs is smaller
MOST_KNOWN = 1 << 20  # scores that are remembered at once; others are found again


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes in the greatest order-keeping matching of two trees in which labels and parents match."""
    pairs: list[tuple[Node, Node]] = []
    _score(a, b, {}, pairs, True)
    return pairs


def _next(row: list[int], x: Node, right: list[Node], known: dict) -> list[int]:
    """The row of the table that follows, for one more sibling on the left."""
    out = [0]
    for j, y in enumerate(right):
        out.append(max(out[j], row[j + 1], row[j] + (_score(x, y, known, None, False) if x.label == y.label else 0)))
    return out


def _table(left: list[Node], right: list[Node], known: dict, collect: bool) -> tuple[int, list[tuple[Node, Node]]]:
    """Score and pairs of the greatest matching of two lists of siblings; no pairs without `collect`."""
    table, both = [[0] * (len(right) + 1)], []
    for x in left:
        table.append(_next(table[-1], x, right, known))
    if collect:
        i, j = len(left), len(right)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                both.append((left[i], right[j]))
        both.reverse()
    return table[-1][-1], both


def _halved(left: list[Node], right: list[Node], known: dict) -> list[tuple[Node, Node]]:
    """Pairs of the greatest matching of two long lists, in the memory of two rows (Hirschberg).

    Siblings at either end that are equal in all nodes score the most that either can, so they are pairs of a greatest
    matching and need no table.
    """

    def equal(x: Node, y: Node) -> bool:
        return x.label == y.label and x.size == y.size and x.text == y.text and _score(x, y, known, None, False) == 2 * x.size

    start, end = 0, 0
    shorter = min(len(left), len(right))
    while start < shorter and equal(left[start], right[start]):
        start += 1
    while end < shorter - start and equal(left[-1 - end], right[-1 - end]):
        end += 1
    ahead, behind = [*zip(left[:start], right[:start])], [*zip(left[len(left) - end:], right[len(right) - end:])]
    left, right = left[start:len(left) - end], right[start:len(right) - end]
    if len(left) < 2 or len(left) * len(right) <= MOST_PAIRS:
        return ahead + _table(left, right, known, True)[1] + behind
    half, n = len(left) // 2, len(right)
    upper, lower = [0] * (n + 1), [0] * (n + 1)
    for x in left[:half]:
        upper = _next(upper, x, right, known)
    back = right[::-1]
    for x in left[:half - 1 if half else None:-1]:
        lower = _next(lower, x, back, known)
    cut = max(range(n + 1), key=lambda j: upper[j] + lower[n - j])
    return ahead + _halved(left[:half], right[:cut], known) + _halved(left[half:], right[cut:], known) + behind


def _score(a: Node, b: Node, known: dict, pairs: list | None, collect: bool) -> int:
    if a.label != b.label:
        return 0
    key = (id(a), id(b))
    if not collect and key in known:
        return known[key]
    left, right = a.children, b.children
    same = 1 + (a.text == b.text)  # among equal shapes, equal texts are aligned
    if not collect and not (left and right):
        return same
    if len(left) * len(right) > MOST_PAIRS:
        both = _halved(left, right, known)
        total = same + sum(_score(x, y, known, None, False) for x, y in both)
    else:
        total, both = _table(left, right, known, collect)
        total += same
    if len(known) >= MOST_KNOWN:
        known.clear()
    known[key] = total
    if collect:
        pairs.append((a, b))
        for x, y in both:
            if x.label == y.label:
                _score(x, y, known, pairs, True)
    return total


def key_of(node: Node, path: str) -> int:
    """What a template remembers of a constant node: where it hangs and what it says."""
    return xxhash.xxh64_intdigest(f"{path}\0{node.text}".encode("utf-8", "surrogatepass")) - (1 << 63)
