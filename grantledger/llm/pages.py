"""Main text of web pages: elements that recur over the pages of a host are its template and go."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import bounded_batches, with_fields
from grantledger.session import settle

#: A subtree is template if it stands on so many different pages of its host.
MIN_PAGES = 5
#: So many of the templates' hashes (8 bytes each), the most frequent ones, go to every task; the others are joined.
SENT_HASHES = 1_000_000

# fixed values: elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot"
    " thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends if it is open, and the elements beyond which it does not look.
ENDED_BY = {
    "li": (frozenset({"li"}), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset({"dl"})),
    "dd": (frozenset("dt dd".split()), frozenset({"dl"})),
    "tr": (frozenset("tr td th".split()), frozenset({"table"})),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
WALLS = frozenset("article main section div table td th body aside nav footer header form".split())
#: Elements without a part in the main text.
DROPPED = frozenset(
    "head script style noscript template iframe object svg canvas nav aside footer form button select input textarea"
    " dialog menu audio video search".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
#: Names that mark menus, notices, adverts, comments and the like.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu menubar breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead cookie cookies consent notice"
    " notices gdpr popup modal overlay newsletter subscribe subscription signup login comment comments commentlist"
    " respond disqus replies share sharing social related recommended recommendations pager pagination toolbar".split()
)
#: What such names are compounded with, as in share-buttons; any other word tells of a title or a subject.
PART_WORDS = frozenset(
    "area bar block box button buttons container footer global header icons inner item items left link links list main"
    " outer panel post posts primary right secondary section site slot sticky toggle top bottom unit wrap wrapper".split()
)
OWN_PARTS = frozenset("comment comments reply replies ad ads advert sponsored related promo teaser".split())
#: Inside the article, only these can be template; its paragraphs may recur as they like.
WRAPPERS = frozenset("div section ul ol table figure header details".split())

_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


@dataclass
class Node:
    tag: str
    attributes: str = ""
    parent: Node | None = None
    inside: list = field(default_factory=list)

    def attribute(self, *names: str) -> str:
        found = [m for m in _ATTRIBUTE.finditer(self.attributes) if m[1].lower() in names]
        return " ".join(next((v for v in m.groups()[1:] if v is not None), m[1]) for m in found)


def _tag_end(html: str, at: int) -> int:
    """The place of the > that ends a tag, quoted values aside."""
    start = at
    while m := _STOP.search(html, at):
        if m[0] == ">":
            return m.start()
        close = html.find(m[0], m.end())
        if close < 0:  # never again in this page, so this costs one look for each kind of quote
            return html.find(">", start)
        at = close + 1
    return html.find(">", start)


def parse(html: str) -> Node:
    """A tree of elements and texts; character references are decoded, open elements end where they must."""
    root = now = Node("html")
    opened: Counter = Counter()
    at, size = 0, len(html)
    while at < size:
        open_ = html.find("<", at)
        if open_ < 0:
            now.inside.append(unescape(html[at:]))
            break
        if open_ > at:
            now.inside.append(unescape(html[at:open_]))
        after = html[open_ + 1 : open_ + 2]
        if html.startswith("<!--", open_):
            end = html.find("-->", open_ + 4)
            at = size if end < 0 else end + 3
        elif after in ("!", "?"):
            end = html.find(">", open_)
            at = size if end < 0 else end + 1
        elif after == "/" or after.isascii() and after.isalpha():
            name = _NAME.match(html, open_ + 1 + (after == "/"))
            end = _tag_end(html, name.end() if name else open_ + 1)
            at = size if end < 0 else end + 1
            if not name:
                continue
            tag = name[0].lower()
            if after == "/":
                now = _closed(now, tag, opened)
                continue
            now = _made_room(now, tag, opened)
            node = Node(tag, html[name.end() : at - 1], now)
            if tag == "html":
                continue
            now.inside.append(node)
            if tag in RAW:
                # the content is no markup; its end tag is the first with that name
                close = re.compile(f"</{tag}(?![a-z0-9])", re.I).search(html, at)
                at = size if close is None else max(html.find(">", close.end()), close.end() - 1) + 1
            elif tag not in VOID:
                now = node
                opened[tag] += 1
        else:
            now.inside.append("<")
            at = open_ + 1
    return root


def _left(now: Node, upto: Node | None, opened: Counter) -> Node:
    """The parent of `upto`, with everything from `now` up to it closed."""
    node = now
    while node is not upto:
        opened[node.tag] -= 1
        node = node.parent
    opened[upto.tag] -= 1
    return upto.parent


def _closed(now: Node, tag: str, opened: Counter) -> Node:
    node = now
    while opened[tag] and node.parent is not None:
        if node.tag == tag:
            return _left(now, node, opened)
        if node.tag in WALLS and tag not in WALLS:
            break
        node = node.parent
    return now


def _made_room(now: Node, tag: str, opened: Counter) -> Node:
    """Where an element goes: what its start ends is closed. Only tags known to be open are looked for."""
    ended, walls = ENDED_BY.get(tag, (frozenset(), frozenset()))
    if tag in BLOCK:
        ended = ended | {"p"}
    open_ = sum(opened[t] for t in ended)
    node, last = now, None
    while open_ and node.parent is not None and node.tag not in walls:
        if node.tag in ended:
            last, open_ = node, open_ - 1
        elif node.tag in WALLS:
            break
        node = node.parent
    return now if last is None else _left(now, last, opened)


@lru_cache(maxsize=1 << 16)
def names_part(name: str, compound: bool = False) -> bool:
    """Whether a class or an id is one of the names or a compound of such and of PART_WORDS; with `compound`, the latter."""
    words = [w.lower() for w in _WORDS.findall(name)]
    said = [w for w in words if not w.isdigit()]
    if len(words) < 2 or len(said) < 2 and compound:
        return not compound and name.lower() in DROPPED_WORDS
    return not DROPPED_WORDS.isdisjoint(said) and all(w in DROPPED_WORDS or w in PART_WORDS for w in said)


def is_named_part(node: Node, in_article: bool) -> bool:
    """Whether an element's classes, or its id as far as it is not made from a title, mark it as no main text.

    Ids of headings, paragraphs and sections come from titles; so may any id of
    one word in an article. Headings, and an article's paragraphs, stay whatever
    their classes are.
    """
    if node.tag in HEADINGS or in_article and node.tag == "p":
        return False
    classes = node.attribute("class").split()
    if any(map(names_part, classes)) or not in_article and any(
        "header" in (words := c.lower().replace("_", "-").split("-")) and PART_WORDS.issuperset(words) for c in classes
    ):
        return True
    if node.tag in ("p", "section") or "section" in classes:
        return False
    return any(names_part(name, in_article) for name in node.attribute("id").split())


def is_dropped(node: Node, in_article: bool) -> bool:
    if node.tag in DROPPED:
        return True
    if node.tag in ("html", "body", "main"):
        return False
    if node.tag == "article":
        return not OWN_PARTS.isdisjoint(node.attribute("class", "id").lower().split())
    if node.tag == "header" and not in_article:
        return True
    if not node.attributes:
        return False
    if node.attribute("role").lower() in DROPPED_ROLES or node.attribute("hidden"):
        return True
    if "display:none" in node.attribute("style").replace(" ", "").lower():
        return True
    return is_named_part(node, in_article)


def subtrees(root: Node, host: str = "") -> dict[int, int]:
    """The hash of each element (by id()): its host and tag, its texts without extra white space, its elements' hashes."""
    seed = xxhash.xxh3_64_intdigest(host)
    out: dict[int, int] = {}
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, done = stack.pop()
        if not done:
            stack.append((node, True))
            stack.extend((child, False) for child in node.inside if isinstance(child, Node))
            continue
        state = xxhash.xxh3_64(node.tag, seed)
        for child in node.inside:
            state.update(f"\1{out[id(child)]}" if isinstance(child, Node) else "\2" + " ".join(child.split()))
        out[id(node)] = state.intdigest() - (1 << 63)
    return out


def may_be_template(node: Node, in_article: bool) -> bool:
    """All outside an article but words within a sentence, whose block recurs or does not; wrappers inside."""
    if in_article:
        return node.tag in WRAPPERS
    if node.tag in ("html", "head", "body", "main", "article"):
        return False
    return node.tag in BLOCK or not any(isinstance(c, str) and not c.isspace() for c in node.parent.inside)


def template_candidates(root: Node, host: str = "") -> set[int]:
    """Hashes of the elements with text that may be template."""
    hashes, out = subtrees(root, host), set()
    stack = [(root, False)]
    while stack:
        node, in_article = stack.pop()
        in_article = in_article or node.tag in ("article", "main")
        for child in node.inside:
            if isinstance(child, Node):
                stack.append((child, in_article))
                if child.inside and may_be_template(child, in_article):
                    out.add(hashes[id(child)])
    return out


def main_text(root: Node, template: frozenset[int], hashes: dict[int, int] | None = None) -> str:
    """The blocks of all articles, or of the main parts or the body without one, in page order, joined by empty lines."""
    if hashes is None:
        hashes = subtrees(root) if template else {}

    def gone(node: Node, in_article: bool) -> bool:
        if is_dropped(node, in_article):
            return True
        return hashes.get(id(node)) in template and may_be_template(node, in_article)

    articles: list[Node] = []
    mains: list[Node] = []
    stack = [(root, False)]
    while stack:  # in page order
        node, in_main = stack.pop()
        if node is not root:
            if gone(node, False):
                continue
            if node.tag == "article":
                articles.append(node)  # what is inside an article is part of it
                continue
            if not in_main and (node.tag == "main" or node.attribute("role").lower() == "main"):
                mains.append(node)
                in_main = True
        stack.extend((child, in_main) for child in reversed(node.inside) if isinstance(child, Node))
    if articles or mains:
        return "\n\n".join(block for top in articles or mains for block in _blocks(top, gone, True))
    return "\n\n".join(_blocks(root, gone, False))


def _blocks(top: Node, gone: Callable[[Node, bool], bool], in_article: bool) -> list[str]:
    out: list[str] = []
    open_: list[str] = []

    def flush() -> None:
        text = " ".join("".join(open_).split())
        if text:
            out.append(text)
        open_.clear()

    # (what, header): texts, elements to enter, and None where a block ends
    stack: list[tuple[object, bool]] = [(top, False)]
    while stack:
        item, header = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            open_.append(item)
        elif item is not top and gone(item, in_article):
            continue
        elif header and item.tag not in HEADINGS and not any(isinstance(c, Node) for c in item.inside):
            continue  # of a header inside the article, only headings are text
        else:
            header = (header or item.tag == "header") and item.tag not in HEADINGS
            if item.tag in BLOCK:
                flush()
                stack.append((None, header))
            elif item.tag in ("br", "td", "th", "img"):
                open_.append(" ")
            for child in reversed(item.inside):
                if not (header and isinstance(child, str)):
                    stack.append((child, header))
    flush()
    return out


def host(url: Column) -> Column:
    """The host of an address in lower case, without user and port; empty for null."""
    name = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(name)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = [parse(html or "") for html in batch.column("html").to_pylist()]
        hosts = batch.column("__host").to_pylist()
        found = [sorted(template_candidates(root, name)) for root, name in zip(roots, hosts, strict=True)]
        bodies = [xxhash.xxh3_128_digest(main_text(root, frozenset())) for root in roots]
        yield pa.RecordBatch.from_arrays(
            [batch.column("__k"), batch.column("__k2"), batch.column("__host"), pa.array(bodies, pa.binary()),
             pa.array(found, pa.list_(pa.int64()))],
            names=["__k", "__k2", "__host", "__body", "subtrees"],
        )


def _extracted(sent: np.ndarray) -> Callable:
    """Texts without the subtrees that are among `sent`, which is sorted, or in the page's own list."""

    def known(hashes: dict[int, int]) -> set[int]:
        if not len(sent):
            return set()
        own = np.fromiter(hashes.values(), np.int64, len(hashes))
        return set(own[sent[np.minimum(np.searchsorted(sent, own), len(sent) - 1)] == own].tolist())

    def text_of(html: str | None, name: str, listed: list[int] | None) -> str:
        root = parse(html or "")
        hashes = subtrees(root, name)
        return main_text(root, frozenset(known(hashes).union(listed or ())), hashes)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("html", "__host", "__template")), strict=True)
            texts = [text_of(*row) for row in rows]
            kept = [n for n in batch.schema.names if n not in ("__host", "__template")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(texts, pa.string())], names=[*kept, "text"]
            )

    return extracted


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.withColumns({
        "__k": F.xxhash64("html"), "__k2": F.xxhash64(F.lit(1), "html"), "__host": host(F.col("url")),
    })


def hashed_pages(pages: DataFrame) -> DataFrame:
    """`__k`, `__k2`, `__host`, `__body`, `subtrees`: keys of each page, and what of it may be template."""
    kind = "__k long, __k2 long, __host string, __body binary, subtrees array<bigint>"
    keyed = _keyed(pages).select("__k", "__k2", "__host", "html")
    return settle(keyed.mapInArrow(_hashed, kind), "subtrees")


def templates(hashed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """`__subtree`, `__on`: the subtrees that recur on their host, whose name is hashed with them, and on how many pages.

    Whatever its addresses, a body counts once on a host, and what stands around it too.
    """
    html = F.struct("__k", "__k2")
    different = hashed.groupBy("__host", "__body").agg(
        F.min(html).alias("__least"), F.max(html).alias("__most"), F.first("subtrees").alias("subtrees")
    )
    alone = different.where("__least = __most").select(F.explode("subtrees").alias("__subtree"))
    several = different.where("__least <> __most").select("__host", "__body")
    around = hashed.join(several, ["__host", "__body"], "left_semi")
    around = around.select("__host", "__body", F.explode("subtrees").alias("__subtree")).distinct()
    counts = alone.union(around.select("__subtree")).groupBy("__subtree").agg(F.count("*").alias("__on"))
    return settle(counts.where(F.col("__on") >= min_pages), "templates")


def _listed(hashed: DataFrame, sent: DataFrame, others: DataFrame) -> DataFrame:
    """For each page with some, its subtrees among `others`; the most frequent ones, `sent`, leave before the join."""
    pages = hashed.groupBy("__host", "__k", "__k2").agg(F.first("subtrees").alias("subtrees"))
    seen = pages.select("__host", "__k", "__k2", F.explode("subtrees").alias("__subtree"))
    seen = seen.join(F.broadcast(sent), "__subtree", "left_anti").join(others, "__subtree", "left_semi")
    return seen.groupBy("__host", "__k", "__k2").agg(F.collect_list("__subtree").alias("__template"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """`pages` (with url, html) and `text`, the main text.

    Every element's subtree is hashed; the hashes are counted by host over the
    pages, with the map side combining, so a host of any size spreads. What
    stands on at least `min_pages` different pages of a host, be it small or
    large, is deleted, beside elements that by their own name or class are no
    main text.
    Paragraphs and headings of an article are never template.

    A null or empty html gives an empty text; a null or odd url has the empty
    host. Pages of a host with one body, as copies under several addresses, count once
    and are treated alike. Other columns pass through, a column named `text` is
    replaced, an empty table gives an empty table.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.drop("text")
    hashed = hashed_pages(rows)
    found = templates(hashed, min_pages)
    sent, joined = found, _keyed(rows)
    if found.count() > SENT_HASHES:
        sent = settle(found.orderBy(F.desc("__on"), "__subtree").limit(SENT_HASHES), "sent")
        listed = _listed(hashed, sent.select("__subtree"), found.join(sent, "__subtree", "left_anti"))
        joined = joined.join(listed, ["__host", "__k", "__k2"], "left")
    else:
        joined = joined.withColumn("__template", F.lit(None).cast("array<bigint>"))
    # at most SENT_HASHES numbers
    hashes = np.sort(sent.select("__subtree").toArrow().column(0).to_numpy())
    return joined.select(*rows.columns, "__host", "__template").mapInArrow(
        _extracted(hashes), with_fields(rows.schema, ("text", "string"))
    )
