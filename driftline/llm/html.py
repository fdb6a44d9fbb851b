"""Main text of web pages: subtrees that recur across a host's pages go, then page furniture by its markup.

First pass: every element outside running text is hashed with its whole subtree, and Spark counts on how many pages
of its host with different texts each hash occurs: copies of a page count once. Second pass: subtrees whose hash recurs
on ``min_pages`` pages and ``min_share`` of the host's pages are deleted, then what is marked up as furniture (menus,
headers, footers, asides, forms, scripts, adverts, notices, reader comments: by tag, role, class or id), since furniture
that occurs once recurs nowhere. Names count on containers that do not hold most of the text, never on headings,
paragraphs or elements in a line. Text blocks of an article or main element (paragraphs, headings, lists, quotes,
tables), also those in its divisions and sections, are never template candidates: a passage that many articles quote
stays. Nor is an element amid text, such as a link in a sentence. A subtree with most of the page's text stays, and if
the deletions of a page would take ``NEAR`` of its text, it is a near copy of others and keeps all of it.

Counting shuffles hashes only, combined before the shuffle, so a host with most pages is no hot key. The deletions of
a page come back by a join on a hash of the row; Spark broadcasts that side only if its counted rows are few.

Defined cases: null html gives an empty text; a page without article or main element is read from its body; a null url
is a host of its own; equal rows give equal results; unclosed tags close where HTML closes them, and at the latest
with their parent. White space is what Unicode calls so; a line break is white space.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fresh, settled, small_side

MIN_PAGES = 5
MIN_SHARE = 0.01
NEAR = 0.8  # share of its text that a near copy has in common with other pages

# HTML's own element lists, fixed values
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
FURNITURE_TAGS = frozenset(
    "nav header footer aside form script style noscript template iframe svg canvas object button select input textarea "
    "dialog head title menu fieldset audio video".split()
)
WRAPPERS = frozenset("form fieldset".split())  # furniture, unless they hold the content
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense adslot sponsor sponsored sponsors promo promotion banner cookie cookies "
    "consent gdpr notice notices newsletter subscribe subscription signup popup modal overlay sidebar sidebars menu nav "
    "navigation navbar topnav breadcrumb breadcrumbs header masthead footer comment comments commentlist disqus respond "
    "reply replies share sharing social related recommended recommendations widget widgets toolbar pagination pager "
    "login search".split()
)
NAMED = frozenset("div section article ul ol dl li table center details figure".split())  # elements whose names count
PLACES = frozenset("site page main top global left right".split())
STATES = frozenset("open closed free none off on enabled disabled".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul "
    "caption".split()
)
TEXT_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption "
    "b i em strong a span u s small sub sup code kbd q cite abbr mark time br hr".split()
)
# elements that only lay out what they hold, and blocks of running text
LAYOUT = frozenset("html body main article section div center".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
# a start tag of the first kind closes an open element of the second, up to the third
CLOSES_P = BLOCKS - {"body", "html", "dd", "dt", "li", "tr", "tbody", "thead", "tfoot", "caption"}
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("table td th caption button article main section div body html aside nav header footer form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.kids: list[Node | str] = []


def parse(source: str) -> Node:
    """A tree of elements and decoded texts, tolerant of missing end tags."""
    root = node = Node("#root", "", None)
    at = 0

    def text(upto: int) -> None:
        if upto > at:
            node.kids.append(html.unescape(source[at:upto]) if "&" in source[at:upto] else source[at:upto])

    def close(tags, barrier) -> Node:
        n = node
        while n is not root:
            if n.tag in tags:
                return n.parent
            if n.tag in barrier:
                break
            n = n.parent
        return node

    while m := _TOKEN.search(source, at):
        text(m.start())
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "p" or tag not in VOID:
                node = close({tag}, SCOPE - {tag} if tag not in BLOCKS else ())
            continue
        if tag in CLOSES_P:
            node = close({"p"}, SCOPE)
        if tag in SIBLINGS:
            node = close(*SIBLINGS[tag])
        child = Node(tag, m[3], node)
        node.kids.append(child)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
            child.kids.append(source[at : end.start() if end else len(source)])
            at = source.find(">", end.start()) + 1 or len(source) if end else len(source)
            continue
        node = child
    text(len(source))
    return root


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(node.attrs)} if node.attrs.strip(" /") else {}


def is_furniture_name(name: str) -> bool:
    """A furniture name, alone, as the leading word (cookie-banner) or after a place (site-footer); no states (comments-open)."""
    words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
    if not words or words[-1] in STATES:
        return False
    return words[0] in FURNITURE_NAMES or len(words) == 2 and words[0] in PLACES and words[1] in FURNITURE_NAMES


def is_marked(node: Node) -> bool:
    """Role, class or id say furniture: class names of containers, and ids as a whole, since ids also come from headings."""
    if node.tag in ("html", "body", "main", "#root") or not node.attrs:
        return False
    a = attributes(node)
    if a.get("role", "").lower() in FURNITURE_ROLES:
        return True
    return node.tag in NAMED and (a.get("id", "").lower() in FURNITURE_NAMES or any(map(is_furniture_name, a.get("class", "").split())))


def text_size(node: Node) -> int:
    """Characters of text below a node, without white space, links and what never is text."""
    size, stack = 0, [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            size += sum(map(len, n.split()))
        elif n is node or n.tag != "a" and (n.tag not in FURNITURE_TAGS or n.tag in WRAPPERS):
            stack.extend(n.kids)
    return size


class Furniture:
    """Tells furniture below the given elements; none is what they are themselves, or what holds most of their text."""

    def __init__(self, tops: list[Node]):
        self.tops, self.total = tops, -1

    def __call__(self, node: Node) -> bool:
        if node.tag in FURNITURE_TAGS and node.tag not in WRAPPERS:
            return True
        if node.tag not in WRAPPERS and not is_marked(node):
            return False
        if any(node is t for t in self.tops):
            return False
        if self.total < 0:
            self.total = sum(map(text_size, self.tops))
        return 2 * text_size(node) <= self.total


def content_roots(root: Node) -> list[Node]:
    """The outermost articles outside furniture; else the main element; else those inside what holds most text; else the whole page."""
    for furniture in (lambda n: n.tag in FURNITURE_TAGS or is_marked(n), Furniture([root])):
        for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or 'role="main"' in n.attrs):
            found, stack = [], [root]
            while stack:
                n = stack.pop()
                if furniture(n):
                    continue
                if wanted(n):
                    found.append(n)
                else:
                    stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))
            if found:
                return found
    return [root]


def walk_up(root: Node) -> list[Node]:
    """All elements, parents before children."""
    order, i = [root], 0
    while i < len(order):
        order.extend(k for k in order[i].kids if isinstance(k, Node))
        i += 1
    return order


def running_text(roots: list[Node]) -> set[int]:
    """Elements that are running text below the content roots, by identity; they are no templates of their own."""
    out: set[int] = set()
    furniture = Furniture(roots)
    stack = [(top, False) for top in roots]
    while stack:
        n, inside = stack.pop()
        amid = any(isinstance(k, str) and not k.isspace() for k in n.kids)
        for k in n.kids:
            if isinstance(k, str) or furniture(k):
                continue
            if inside or amid and k.tag not in BLOCKS:
                out.add(id(k))
                stack.append((k, True))
            elif k.tag in LAYOUT:
                stack.append((k, False))
            elif roots[0].tag != "#root" and k.tag in TEXT_BLOCKS:
                out.add(id(k))
                stack.append((k, True))
            else:
                stack.append((k, k.tag in RUNNING))
    return out


def subtree_hashes(root: Node, host: str) -> dict[int, int]:
    """64-bit hashes, salted by the host, of the subtrees that may be a template; by element's identity."""
    order = walk_up(root)
    roots = content_roots(root)
    spared = running_text(roots) | {id(n) for n in order if n.tag in ("#root", "html", "head", "body", "main", "article")}
    for n in roots:
        while n is not None:  # what holds the content is none either
            spared.add(id(n))
            n = n.parent
    digest: dict[int, bytes] = {}
    out: dict[int, int] = {}
    for n in reversed(order):
        h = hashlib.blake2b(f"{host}\0{n.tag}\0{n.attrs.strip()}\0".encode("utf-8", "replace"), digest_size=8)
        for k in n.kids:
            h.update(digest[id(k)] if isinstance(k, Node) else " ".join(k.split()).encode("utf-8", "replace"))
        digest[id(n)] = h.digest()
        if id(n) not in spared:
            out[id(n)] = int.from_bytes(h.digest(), "little", signed=True)
    return out


def dropped(root: Node, host: str, lost: set[int]) -> set[int]:
    """The elements to delete, by identity, of those whose hash recurs."""
    recur = {k for k, h in subtree_hashes(root, host).items() if h in lost}
    roots = content_roots(root)
    furniture, total, taken = Furniture(roots), sum(map(text_size, roots)), 0
    out: set[int] = set()
    stack = list(roots)
    while stack:
        n = stack.pop()
        if id(n) not in recur:
            stack.extend(k for k in n.kids if isinstance(k, Node) and not furniture(k))
            continue
        size = text_size(n)
        if 2 * size <= total:
            out.add(id(n))
            taken += size
    return out if taken < NEAR * total or not total else set()


def text_blocks(root: Node, drop: set[int]) -> list[str]:
    """Texts of the blocks below the content roots, without the dropped elements and furniture."""
    blocks: list[str] = []
    now: list[str] = []

    def cut() -> None:
        if now:
            joined = " ".join("".join(now).split())
            if joined:
                blocks.append(joined)
            now.clear()

    roots = content_roots(root)
    furniture = Furniture(roots)
    for top in roots:
        stack: list = [top]
        while stack:
            n = stack.pop()
            if n is None:
                cut()
            elif isinstance(n, str):
                now.append(n)
            elif id(n) in drop or furniture(n):
                cut() if n.tag in BLOCKS else now.append(" ")
            elif n.tag in BLOCKS:
                cut()
                stack.append(None)
                stack.extend(reversed(n.kids))
            else:
                if n.tag in ("br", "td", "th", "wbr", "img"):
                    now.append("" if n.tag == "wbr" else " ")
                stack.extend(reversed(n.kids))
        cut()
    return blocks


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, hosts, hashes, contents = [], [], [], []
        for row, url, source in zip(*(b.column(i).to_pylist() for i in range(3))):
            host = host_of(url)
            root = parse(source or "")
            found = set(subtree_hashes(root, host).values())
            content = hashlib.blake2b("\n".join(text_blocks(root, set())).encode("utf-8", "replace"), digest_size=8)
            rows += [row] * (len(found) + 1)
            hosts += [host] * (len(found) + 1)
            hashes += [*found, None]  # the last stands for the page itself
            contents += [int.from_bytes(content.digest(), "little", signed=True)] * (len(found) + 1)
        arrays = [pa.array(rows, pa.int64()), pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(contents, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["row", "host", "hash", "content"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for url, source, gone in zip(*(b.column(i).to_pylist() for i in range(3))):
            root = parse(source or "")
            drop: set[int] = set()
            if gone:
                drop = dropped(root, host_of(url), set(gone))
            out.append("\n".join(text_blocks(root, drop)))
        arrays = [b.column(i) for i in range(3, b.num_columns)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.string())], [*b.schema.names[3:], "text"])


def templates(hashed: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, hash) of the subtrees that recur on many pages of their host; pages of the same text count once."""
    counts = hashed.select("host", "hash", "content").distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = settled(counts.where(f"hash IS NULL OR n >= {int(min_pages)}"), "html-counts")
    hosts = counts.where("hash IS NULL").select("host", F.col("n").alias("pages"))
    return counts.where("hash IS NOT NULL").join(small_side(hosts), "host").where(F.col("n") >= min_share * F.col("pages")).select("host", "hash")


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Add the column ``text`` (replacing one of that name) to pages with the columns url and html."""
    row, gone = fresh(pages, "_row"), fresh(pages, "_gone")
    keyed = pages.withColumn(row, F.xxhash64("url", "html", F.sha1(F.coalesce("html", F.lit("")))))
    hashed = settled(keyed.select(F.col(row).alias("row"), "url", "html").mapInArrow(_hashes, "row bigint, host string, hash bigint, content bigint"), "html-hashes")
    known = small_side(settled(templates(hashed, min_pages, min_share), "html-templates"))
    lost = hashed.where("hash IS NOT NULL").join(known, ["host", "hash"])
    lost = small_side(settled(lost.groupBy(F.col("row").alias(row)).agg(F.collect_set("hash").alias(gone)), "html-lost"))
    rest = [c for c in pages.columns if c.lower() != "text"]
    fed = keyed.join(lost, row, "left").select(F.col("url").alias(fresh(pages, "_url")), F.col("html").alias(fresh(pages, "_html")), F.col(gone), *[F.col(c) for c in rest])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*rest).schema) + ", text string"
    return fed.mapInArrow(_texts, schema)
