"""Main text of HTML pages by site template removal.

Each page is parsed once, in time linear in its length, into blocks of text and the
tree of element subtrees around them, each with a hash.  Subtrees are counted for
each host over different pages; those that recur on many pages of a host are its
template and are deleted with the blocks inside.  Elements that say what they are
(menus, footers, adverts, forms, comments and so on, by tag, role, class or id)
need no counting.

Inside ``article`` and ``main`` only containers count as template, never a
paragraph, heading or list item: an article may quote a sentence that recurs.
Blocks outside them stay like any others unless they are template or furniture,
as a page may use ``article`` for a teaser only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import bound_batches, keep, store, tidy

MIN_PAGES = 4  # a template's subtree is on this many different pages of its host at least
MIN_SHARE = 0.3  # and on this share of them

# a quoted attribute value begins after "=" only, as in HTML's own tokeniser
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+\"[^\"]*\"|=\s*+'[^']*'|=)*+)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# fixed values: element names by role in HTML, and the usual names of page furniture
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe template svg math xmp noembed noframes".split())
_DROPPED = frozenset("nav footer aside form button select option dialog menu object audio video canvas head label fieldset datalist".split()) | _RAW
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table caption tbody thead tfoot tr ul".split())
_CONTAINERS = frozenset("div section ul ol dl table figure details header hgroup center".split())
_ROOTS = frozenset(("article", "main"))
_CLOSES_P = _BLOCKS - frozenset("body html caption tbody thead tfoot tr li dd dt figcaption summary".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table article main body section div".split())
_ENDED = frozenset("li dt dd tr td th tbody thead option".split())
_COMMENTS = frozenset("comment comments commentlist replies reply respond disqus related recommended recommendations".split())
_FURNITURE = _COMMENTS | frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager footer sidebar aside widget widgets ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login social share "
    "sharing toolbar masthead skip".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_WRAPS = frozenset(("has", "no", "with", "without", "is"))
# parts of a class that say where something is, not what it is
_PLACES = frozenset(
    "list box block area section wrapper wrap container bar button buttons link links icon icons item items inner outer top bottom left right header head body form "
    "thread post posts article articles story stories site page global primary secondary mobile desktop sticky fixed slot unit row col column panel text title label".split()
)

_COMMENT, _SOFT, _HARD = 1, 2, 4


def _label(tag: str, attributes: str, in_root: bool) -> int:
    """What the element's own tag and attributes say: ``_HARD`` or ``_SOFT`` furniture (by class or id), reader comments, or 0."""
    if tag in _DROPPED or (tag == "header" and not in_root):
        return _HARD
    if not attributes or tag in ("body", "html"):
        return 0
    found = 0
    for name, one, two, three in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), one or two or three
        if name == "hidden" and value != "false" or name == "aria-hidden" and value == "true":
            return _HARD
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return _HARD
        if name == "role" and value.lower() in _ROLES and tag not in _ROOTS:
            return _HARD
        if name in ("class", "id"):
            for word in value.split():
                parts = {x for x in _SPLIT.split(_CAMEL.sub("-", word).lower()) if not x.isdigit()} - {""}
                # every part must fit: "related-posts" is furniture, "related-work" is not
                if parts & _FURNITURE and not parts - _FURNITURE - _PLACES and not parts & _WRAPS:
                    if tag not in _ROOTS or parts & _COMMENTS:
                        found |= _SOFT | (_COMMENT if parts & _COMMENTS else 0)
                elif "header" in parts and not parts - _PLACES and not in_root and tag in ("div", "section"):
                    found |= _SOFT
    return found


class _Element:
    __slots__ = ("tag", "parent", "label", "in_root", "commented", "labelled", "hasher", "node", "digest", "holds_root", "dead", "used")

    def __init__(self, tag: str, parent: _Element | None, attributes: str):
        self.tag, self.parent = tag, parent
        inside = parent is not None and parent.in_root
        self.label = _label(tag, attributes, inside) if parent is not None else 0
        self.in_root = inside or tag in _ROOTS
        self.commented = bool(self.label & _COMMENT) or (parent is not None and parent.commented)
        self.labelled = self.label > 0 or (parent is not None and parent.labelled)
        self.hasher = xxhash.xxh3_64() if tag in _CONTAINERS or (not self.in_root and tag in _BLOCKS) else None
        self.digest, self.holds_root, self.dead, self.used, self.node = 0, False, False, False, -1


def _signed(digest: int) -> int:
    return digest - (1 << 63)


def parse(html: str) -> tuple[list[tuple[str, int]], list[tuple[int, int]]]:
    """The blocks of a page in order, each with its place in the tree (-1: none), and the tree.

    A node of the tree is an element whose deletion takes its blocks along: (hash,
    place of the node around it or -1), outer nodes first.  Blocks in furniture are
    not given.  A block outside ``article`` and ``main`` that no such element holds is
    a node of its own text.
    """
    blocks: list[tuple[list[str], _Element]] = []
    root = _Element("html", None, "")
    stack, elements, roots = [root], [root], []
    holders = [root]  # the open elements that are hashed
    root.hasher = root.hasher or xxhash.xxh3_64()
    open_tags: Counter[str] = Counter()
    barriers: list[int] = []  # depths of the open block elements
    scoped: list[int] = []  # depths of the open elements that end others, or stop them from ending
    fresh, at, raw, mark = True, 0, None, 0

    def add(text: str) -> None:
        nonlocal fresh
        if fresh:
            blocks.append(([], stack[-1]))
            fresh = False
        blocks[-1][0].append(unescape(text) if "&" in text else text)

    def close(depth: int, end: int) -> None:
        nonlocal fresh, mark
        while len(stack) > depth:
            element = stack.pop()
            open_tags[element.tag] -= 1
            if barriers and barriers[-1] == len(stack):
                barriers.pop()
            if scoped and scoped[-1] == len(stack):
                scoped.pop()
            if element.tag in _BLOCKS:
                fresh = True
            if element.hasher is not None:
                element.hasher.update(html[mark:end].encode("utf-8", "replace"))
                mark = end
                element.digest = element.hasher.intdigest()
                element.hasher = None
                holders.pop()
                holders[-1].hasher.update(element.digest.to_bytes(8, "little"))

    limit = html.rfind(">") + 1  # what comes after is text
    for match in _TOKEN.finditer(html, 0, limit):
        start = match.start()
        if start < at:
            continue
        if raw is None and start > at:
            add(html[at:start])
        closing, tag, attributes = match.groups()
        if tag is None:  # a comment or a declaration
            at = match.end() if match[0].endswith(">") else len(html)
            continue
        tag = tag.lower()
        if raw is not None:
            if not (closing and tag == raw):
                continue
            raw, at = None, match.end()
            close(len(stack) - 1, at)
            continue
        at = match.end()
        if closing:
            if open_tags[tag] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(depth, at)
            continue
        if tag in ("html", "body"):
            continue
        if tag in _CLOSES_P and barriers and stack[barriers[-1]].tag == "p":
            close(barriers[-1], start)
        if tag in _SIBLINGS:
            ended = _SIBLINGS[tag]
            for depth in reversed(scoped):
                if stack[depth].tag in ended:
                    close(depth, start)
                    if stack[-1].tag not in ended:
                        break
                elif stack[depth].tag in _SCOPES:
                    break
        if tag in _BLOCKS:
            fresh = True
        elif tag in ("br", "td", "th") and not fresh:
            add(" ")
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCKS:
            continue
        element = _Element(tag, stack[-1], attributes)
        if tag in _ROOTS and not element.commented:
            roots.append(element)
        if tag in _BLOCKS:
            barriers.append(len(stack))
        if tag in _SCOPES or tag in _ENDED:
            scoped.append(len(stack))
        if element.hasher is not None:
            holders[-1].hasher.update(html[mark:start].encode("utf-8", "replace"))
            mark = start
            holders.append(element)
        open_tags[tag] += 1
        stack.append(element)
        elements.append(element)
        if tag in _RAW:
            raw = tag
    if raw is None and at < len(html):
        add(html[at:])
    close(1, len(html))

    # what holds the article isn't furniture, whatever its class says
    best = min(roots, key=lambda e: (e.labelled, e.tag != "main"), default=None)
    while best is not None and not best.holds_root:
        best.holds_root = True
        best = best.parent
    for element in elements[1:]:  # parents come before their children
        element.dead = element.parent.dead or bool(element.label & _HARD) or (element.label > 0 and not element.holds_root)

    found, nodes = [], []
    for pieces, inner in blocks:
        text = " ".join("".join(pieces).split())
        if text and not inner.dead:
            found.append((text, inner))
            while inner is not None and not inner.used:
                inner.used = True
                inner = inner.parent
    for element in elements[1:]:
        element.node = element.parent.node
        if element.used and (element.tag in _CONTAINERS or (not element.in_root and element.tag in _BLOCKS)):
            nodes.append((_signed(element.digest), element.node))
            element.node = len(nodes) - 1
    placed = []
    for text, inner in found:
        place = inner.node
        if place < 0 and not inner.in_root and roots:
            nodes.append((_signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))), -1))
            place = len(nodes) - 1
        placed.append((text, place))
    return placed, nodes


_PARSED = "row long, page_id long, url string, host string, page_print long, texts array<string>, places array<int>, hashes array<long>, parents array<int>"
_CLEAN = "page_id long, url string, text string"


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [h or "" for h in batch.column("html").to_pylist()]
        found = [parse(h) for h in pages]
        prints = [_signed(xxhash.xxh3_64_intdigest(h.encode("utf-8", "replace"))) for h in pages]
        own = {c: batch.column(c) for c in ("row", "page_id", "url", "host")}
        yield pa.record_batch({
            **own, "page_print": pa.array(prints, pa.int64()),
            "texts": pa.array([[t for t, _ in b] for b, _ in found], pa.list_(pa.string())),
            "places": pa.array([[p for _, p in b] for b, _ in found], pa.list_(pa.int32())),
            "hashes": pa.array([[h for h, _ in n] for _, n in found], pa.list_(pa.int64())),
            "parents": pa.array([[p for _, p in n] for _, n in found], pa.list_(pa.int32())),
        })


def _without_template(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the blocks that are in no deleted node, joined by empty lines."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("texts", "places", "hashes", "parents", "deleted"))
        found = []
        for texts, places, hashes, parents, deleted in zip(*columns, strict=True):
            if deleted:
                gone, dead = set(deleted), []
                for own, parent in zip(hashes, parents, strict=True):
                    dead.append(own in gone or (parent >= 0 and dead[parent]))
                texts = [t for t, p in zip(texts, places, strict=True) if p < 0 or not dead[p]]
            found.append("\n\n".join(texts))
        yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(found, pa.string())})


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of each page, the article's blocks joined by an empty line.

    White space in a block is one space; character references are decoded.  A null
    or empty page has an empty text; pages without a host (a null url, or one
    without ``://``) are counted as one site.  Exact copies of a page count once
    for the template, so copies alone never make one.  Repeated rows stay; other
    columns are not read; an empty table gives an empty result.  Broken, deep and
    very long pages are parsed like any others, in linear time.
    """
    bound_batches(pages.sparkSession, rows=500, size="8m")
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"://([^/?#]*)", 1))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    parsed = store(rows.mapInArrow(tidy(_parse_pages), _PARSED), "parsed")
    subtrees = parsed.select("row", "host", "page_print", F.explode(F.array_distinct("hashes")).alias("subtree"))
    many = subtrees.groupBy("host", "subtree").agg(F.count_distinct("page_print").alias("n")).where(F.col("n") >= min_pages)
    sites = parsed.groupBy("host").agg(F.count_distinct("page_print").alias("site_pages"))
    template = many.join(sites, "host").where(F.col("n") >= F.col("site_pages") * min_share).select("host", "subtree")
    deleted = keep(subtrees.join(template, ["host", "subtree"]).groupBy("row").agg(F.collect_set("subtree").alias("deleted")))
    found = parsed.drop("host", "page_print").join(deleted, "row", "left").drop("row").mapInArrow(tidy(_without_template), _CLEAN)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
