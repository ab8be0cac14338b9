"""Main text of web pages by wrapper induction.

All pages of each host are aligned by where their nodes hang. Nodes that say the same on nearly all of them, or on nearly
all pages of one layout, are template; the rest are slots. From a page, the template and whatever is marked as navigation, notice, advert, form or comments go;
of what is left, the article is taken.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.dom import INLINE, Node, key_of, parse
from hazeline.session import written

LEAST = 4  # different pages of a host or layout; else it has no template
SLOT = 0.7  # share of a page's text that one element must hold to be looked into
CONSTANT = 0.8  # share of the pages that say the same
BATCH_BYTES = 8 << 20

#: Elements and words in class, id and role that mark what isn't the article.
ASIDE_TAGS = frozenset("nav aside footer form button fieldset menu dialog head".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription social share sharing related "
    "recommended recommendations comment comments commentlist reply replies respond discussion disqus toolbar pagination pager login signup search skip complementary contentinfo".split())
#: Words that only say that something is a container or a list.
CONTAINER_WORDS = frozenset("area articles bar block box button buttons container content form group inner item items link links list panel posts section stories widget wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORD = re.compile(r"[a-z]+")


def host(url: Column | str) -> Column:
    """The host of a web address; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.when(found != "", found)


def _named_aside(names: str) -> bool:
    """Whether one whole name says so: `share-buttons` does, `share-price` and `related-work` don't."""
    for name in names.split():
        words = set(WORD.findall(name))
        if words & ASIDE_WORDS and words <= ASIDE_WORDS | CONTAINER_WORDS:
            return True
    return False


def is_aside(node: Node, in_article: bool) -> bool:
    """Whether an element isn't the article's. Outside it any word of its names counts, inside only whole names."""
    if node.hidden or node.tag in ASIDE_TAGS or node.tag == "header" and not in_article:
        return True
    if node.names and node.tag not in ("article", "main", "body", "html"):
        if in_article:
            return _named_aside(node.names)
        return not ASIDE_WORDS.isdisjoint(WORD.findall(node.names)) or "header" in WORD.findall(node.names)
    return node.tag == "article" and bool(node.names) and not {"comment", "reply"}.isdisjoint(WORD.findall(node.names))


def _content_path(tree: Node) -> str:
    """Where most of a page's text hangs: down from the root for as long as one child has nearly all of it."""
    node = tree
    while True:
        kept = [(len(x.text), x) for x in node.children if not is_aside(x, False) and x.tag not in INLINE]
        most, child = max(kept, key=lambda x: x[0], default=(0, None))
        if child is None or child.tag == "p" or most < SLOT * max(1, sum(n for n, _ in kept)):
            return node.path()
        node = child


def described(html: str) -> tuple[str, list[int], list[int]]:
    """Of a page the path of its content, and the keys of its nodes outside and inside of articles."""
    tree = parse(html)
    keys: tuple[set[int], set[int]] = set(), set()
    stack = [(tree, tree.path(), False)]
    while stack:
        node, path, inside = stack.pop()
        for x in node.children:
            if x.tag in INLINE or not x.text:
                continue
            here, within = f"{path}/{x.label}", inside or x.tag in ("article", "main")
            keys[within].add(key_of(x, here))
            stack.append((x, here, within))
    return _content_path(tree), sorted(keys[False]), sorted(keys[True])


def is_constant(n: int | Column, pages: int | Column, inside: bool | Column) -> bool | Column:
    """Whether what stands on `n` of some pages is their template; within the article only what all of them say."""
    return (n >= CONSTANT * pages) & (~inside | (n == pages) if isinstance(inside, Column) else (not inside) | (n == pages))


def induce(pages: list[str]) -> tuple[list[int], str | None]:
    """Keys of the constant nodes of a host and the path of its content slot, from its pages: `templates` in one task.

    Nothing if there are too few different pages.
    """
    seen = [described(x) for x in dict.fromkeys(pages)]
    if len(seen) < LEAST:
        return [], None
    slots = Counter(x[0] for x in seen).most_common()
    slot = min(x for x, n in slots if n == slots[0][1])
    found: set[int] = set()
    for some in (seen, [x for x in seen if x[0] == slot]):
        if len(some) >= LEAST:
            for inside in (False, True):
                found |= {k for k, n in Counter(k for x in some for k in x[1 + inside]).items() if is_constant(n, len(some), inside)}
    return sorted(found), slot


def _at(node: Node, path: str, found: list[Node]) -> list[Node]:
    if node.path() == path:
        found.append(node)
    elif path.startswith(node.path() + "/"):
        for x in node.children:
            _at(x, path, found)
    return found


def _articles(node: Node, found: list[Node]) -> None:
    for x in node.children:
        if not is_aside(x, False):
            if x.tag in ("article", "main") or "main" in x.names.split():
                found.append(x)
            else:
                _articles(x, found)


class _Blocks:
    """Texts of blocks in page order; each with the part of it that lies in links, of which headings have none."""

    def __init__(self, template: frozenset[int]):
        self.template, self.done, self.open, self.linked = template, [], [], 0

    def close(self) -> None:
        text = " ".join("".join(self.open).split())
        if text:
            self.done.append((text, self.linked / len(text)))
        self.open, self.linked = [], 0

    def take(self, node: Node, path: str, in_article: bool, in_link: bool = False, heading: bool = False) -> None:
        for x in node.parts:
            if isinstance(x, str):
                self.open.append(x)
                self.linked += in_link * len(" ".join(x.split()))
                continue
            here = f"{path}/{x.label}"
            if is_aside(x, in_article) or self.template and x.tag not in INLINE and x.text and key_of(x, here) in self.template:
                if x.tag not in INLINE:
                    self.close()
                continue
            if x.tag not in INLINE:
                self.close()
            self.take(x, here, in_article, (in_link or x.tag == "a") and not heading and x.tag not in HEADINGS, heading or x.tag in HEADINGS)
            if x.tag not in INLINE:
                self.close()


def main_text(html: str | None, template: frozenset[int] = frozenset(), slot: str | None = None) -> str:
    """The article of a page: all that is marked as such, else the host's content slot, else all that isn't links."""
    if not html:
        return ""
    tree = parse(html)
    found: list[Node] = []
    _articles(tree, found)
    if not found and slot and slot != tree.path():
        found = _at(tree, slot, [])
    if any(x.text for x in found):
        blocks = _Blocks(template)
        for article in found:  # in page order; none lies in another
            blocks.take(article, article.path(), True)
            blocks.close()
        return " ".join(t for t, _ in blocks.done)
    blocks = _Blocks(template)
    blocks.take(tree, tree.path(), False)
    blocks.close()
    return " ".join(t for t, linked in blocks.done if linked <= 0.5)


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, template, slot) of hosts and (host, own_slot, own) of their layouts, each of at least `LEAST` different pages.

    All different pages of a host are counted. Those whose content hangs in the same place are one layout; a node that says
    the same on nearly all pages of the host or of the layout is constant. Pages leave their tasks as keys of their nodes,
    and counts are summed by key, so a host of any size is counted by many tasks.
    """
    rows = pages.select(host("url").alias("host"), F.xxhash64("html").alias("hash"), "html").where("host is not null and html is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                slots, outside, inside = zip(*(described(x.as_py()) for x in some.column(2)))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(slots, pa.string()), pa.array(outside, longs), pa.array(inside, longs)], ["host", "hash", "slot", "outside", "inside"])

    seen = rows.mapInArrow(run, "host string, hash long, slot string, outside array<long>, inside array<long>")
    seen = seen.groupBy("host", "hash").agg(*(F.first(x).alias(x) for x in ("slot", "outside", "inside")))
    seen = written(seen, "pages-seen")
    layouts = written(seen.groupBy("host", "slot").agg(F.count("*").alias("pages")), "layouts")
    hosts = layouts.groupBy("host").agg(F.sum("pages").alias("all_pages"), F.min(F.struct(-F.col("pages"), "slot"))["slot"].alias("top")).where(F.col("all_pages") >= LEAST)
    keys = seen.select("host", "slot", F.explode("outside").alias("key"), F.lit(False).alias("inside")).unionAll(
        seen.select("host", "slot", F.explode("inside").alias("key"), F.lit(True).alias("inside")))
    # What stands on fewer pages is constant neither of a layout nor of a host.
    counts = keys.groupBy("host", "slot", "key", "inside").agg(F.count("*").alias("n"))
    counts = written(counts.withColumn("all_n", F.sum("n").over(Window.partitionBy("host", "key", "inside"))).where(F.col("all_n") >= CONSTANT * LEAST), "node-counts")
    own = (
        counts.join(layouts.where(F.col("pages") >= LEAST), ["host", "slot"]).where(is_constant(F.col("n"), F.col("pages"), F.col("inside")))
        .groupBy("host", "slot").agg(F.collect_list("key").alias("own"))
    )
    own = layouts.where(F.col("pages") >= LEAST).join(own, ["host", "slot"], "left").select("host", F.col("slot").alias("own_slot"), "own")
    every = counts.select("host", "key", "inside", "all_n").distinct().join(hosts, "host")
    every = every.where(is_constant(F.col("all_n"), F.col("all_pages"), F.col("inside"))).groupBy("host").agg(F.collect_list("key").alias("template"))
    return hosts.join(every, "host", "left").select("host", "template", F.col("top").alias("slot")), own


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row (page_id, url, html).

    An empty text for a null or empty page, and for one without an article. A page without host, or of a host with few
    different pages, is read without a template. Repeated rows give repeated rows, an empty table an empty result.
    """
    hosts, layouts = (written(x, "templates") for x in templates(pages))
    kind = dict(pages.dtypes)["page_id"]
    rows = pages.select("page_id", "url", "html", host("url").alias("host"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [_content_path(parse(h.as_py())) if u.is_valid and h.is_valid else None for h, u in zip(batch.column(2), batch.column(3))]
            yield batch.append_column("place", pa.array(slots, pa.string()))

    rows = rows.mapInArrow(placed, f"page_id {kind}, url string, html string, host string, place string").alias("p")
    both = (
        rows.join(hosts.alias("h"), F.col("p.host") == F.col("h.host"), "left")
        .join(layouts.alias("l"), (F.col("p.host") == F.col("l.host")) & (F.col("p.place") == F.col("l.own_slot")), "left")
        .select("page_id", "url", "html", F.concat(F.coalesce("template", F.array()), F.coalesce("own", F.array())).alias("template"), F.coalesce("own_slot", "slot").alias("slot"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, out = 0, 0, []
            for i in range(batch.num_rows):
                out.append(main_text(batch.column(2)[i].as_py(), frozenset(batch.column(3)[i].as_py() or ()), batch.column(4)[i].as_py()))
                size += len(out[-1])
                if size >= BATCH_BYTES or i == batch.num_rows - 1:
                    some = batch.slice(first, len(out))
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])
                    first, size, out = i + 1, 0, []

    return both.mapInArrow(run, f"page_id {kind}, url string, text string")
