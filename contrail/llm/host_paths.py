"""Main text of web pages by consensus host paths.

Every page is read into containers; a container scores by all the running text
inside it, links discounted. A page's own container is found from the element with
most text: its outermost article or main, or else what it climbs to while more text
with few links or a headline comes in. Pages of one host share templates, so each
page votes for the generalised tag-class paths on that climb, Spark sums the votes
per host, and the pages are extracted again with their host's winning path: from there
the page is climbed as long as article text comes in. A page whose own container holds more uses that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import reach_workers, stored, text_slices

# HTML element names by role.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|annotation|annotation-xml|object|canvas|select|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr br"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup"
    " munder mover munderover mmultiscripts mtable mtr mtd maction semantics".split())
DROPPED = frozenset("head nav footer aside form button input dialog menu fieldset audio video map".split())
CLOSES_ITSELF = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# A new item closes an open one only up to these.
SCOPES = frozenset("ul ol dl table div section article main body html td th blockquote aside nav footer header".split())
# Words in class, id and role that mark what is no main text; a trailing * takes any ending.
MARKS = (
    "ad ads adv advert* adslot adsense sponsor* promo* nav navbar navigation menu* sidebar* aside footer* foot masthead topbar"
    " cookie* consent* gdpr notice notices notification* alert alerts banner banners toast popup* modal* overlay* newsletter*"
    " subscri* signup login signin paywall comment comments commentlist discussion disqus replies reply respond share sharing"
    " social related recommend* breadcrumb* pagination pager widget widgets toolbar search searchform contentinfo complementary"
    " search skip tagcloud").split()
_EXACT = frozenset(m for m in MARKS if m[-1] != "*")
_PREFIX = tuple(m[:-1] for m in MARKS if m[-1] == "*")
# Words beside a mark that leave a name a name of layout ("comments-section"); with any other word
# ("related-work") a name inside an article may be its own subject.
LAYOUT_WORDS = frozenset(
    "section list listing box container wrapper wrap block area panel module group row col column grid item items entry unit slot"
    " posts post article articles story stories links link news topics videos video more read reading bar button buttons icon icons"
    " tools title header heading head body inner outer left right top bottom main content text page site form field input thread"
    " threads user users reader readers author meta count counter sticky inline float mobile desktop js fb facebook twitter google"
    " media network networks follow up letter email mail sign in out us me on the for you your view views show load also like likes"
    " wide small large big mini dark light hidden visible default primary secondary id no new latest popular trending and by to".split())
PAGE_HEADER = frozenset(("header", "banner", "siteheader", "pageheader"))

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^>\"']++)*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Containers a page votes for, and characters of a block that runs as text.
VOTES, RUNNING = 3, 80
#: A climb takes in a parent whose added text has at most this share in links, and a headline or at least that share of new text.
MOST_LINKED, LEAST_ADDED = 0.3, 0.1
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: A class that says a page has or lacks a sidebar is no sidebar: what follows these words marks nothing.
LAYOUT = frozenset("has no with without".split())


class Node:
    __slots__ = ("tag", "path", "parent", "dropped", "shut", "score", "direct", "chars", "linked", "heads", "inside", "in_article",
                 "cut", "doubtful", "held", "held_linked", "longest")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent, self.score, self.direct = tag, parent, 0.0, 0.0
        self.chars = self.linked = self.heads = 0
        self.held = self.held_linked = self.longest = 0
        names, hidden = "", False
        marks: set[str] = set()
        # a header of the page is no main text, a header inside an article is
        self.inside = bool(parent and parent.inside) or tag in ("article", "main")
        plain = False
        if attrs and "=" in attrs or "hidden" in attrs:
            for m in ATTR.finditer(attrs):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    hidden = True
                elif key != "aria-hidden":
                    for name in value.split():
                        parts = [w.lower() for w in WORD.findall(name)]
                        parts = parts[:next((i for i, w in enumerate(parts) if w in LAYOUT), len(parts))]
                        named = {*parts, "".join(parts)}
                        marks |= named
                        # a name of nothing but marks and layout words says what the element is
                        plain = plain or is_marked(named) and all(w in LAYOUT_WORDS or w.isdigit() or is_marked({w}) for w in parts)
                    if key == "class":
                        names = "".join("." + re.sub(r"[0-9]+", "#", c) for c in sorted(value.lower().split()))
        self.path = f"{parent.path}/{tag}{names}" if parent else ""
        header = not self.inside and (tag == "header" or bool(marks & PAGE_HEADER))
        keep = tag in ("html", "body", "article", "main")
        # elements and hidden parts shut all that is inside; a wrapper's class doesn't take an outermost article or main with it
        self.shut = bool(parent and parent.shut) or hidden or tag in DROPPED or tag == "header" and not self.inside
        self.in_article = bool(parent and parent.in_article) or tag == "article"
        marked = not keep and is_marked(marks)
        self.doubtful = marked and self.inside and not plain
        self.cut = header or marked and not self.doubtful or (
            tag == "article" and not marks.isdisjoint(("comment", "comments", "reply", "ad", "advert", "promo", "related", "sponsored", "teaser")))
        self.dropped = False

    def settle(self) -> None:
        """Decide on this element once its text is known and its parent is decided. A doubtful name cuts what is mostly links
        or has no running text."""
        doubt = self.doubtful and (self.held_linked > MOST_LINKED * self.held or self.longest < RUNNING)
        wrapped = bool(self.parent and self.parent.dropped) and (self.tag not in ("article", "main") or self.parent.in_article)
        self.dropped = self.shut or wrapped or self.cut or doubt


def is_marked(words: set[str]) -> bool:
    return not words.isdisjoint(_EXACT) or any(w.startswith(_PREFIX) for w in words)


def blocks_of(html: str) -> tuple[list[tuple[str, Node]], list[Node]]:
    """The blocks of text in page order, each with the element it stands in, and all elements."""
    root = Node("", "", None)
    stack, nodes, blocks = [root], [root], []
    links_in: list[int] = []
    text: list[str] = []
    linked, at = 0, 0
    links = 0

    def flush() -> None:
        nonlocal linked
        block = " ".join(unescape("".join(text)).split()) if text else ""
        text.clear()
        if block:
            here = next(n for n in reversed(stack) if n.tag not in INLINE)
            blocks.append((block, here))
            links_in.append(linked)
        linked = 0

    for m in TOKEN.finditer(html):
        if m.start() > at:
            piece = html[at:m.start()]
            text.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if m["close"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    links -= sum(n.tag == "a" for n in stack[i:])
                    del stack[i:]
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        if tag not in INLINE:
            ends = CLOSES_ITSELF.get(tag, ()) + (() if tag == "p" else ("p",))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    links -= sum(n.tag == "a" for n in stack[i:])
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag not in VOID and not m["attrs"].endswith("/"):
            node = Node(tag, m["attrs"], stack[-1])
            stack.append(node)
            nodes.append(node)
            links += tag == "a"
    if at < len(html):
        text.append(html[at:])
    flush()
    weigh(blocks, links_in, nodes)
    return blocks, nodes


def weigh(blocks: list[tuple[str, Node]], links_in: list[int], nodes: list[Node]) -> None:
    """Settle which elements are no main text, and score the others by their text, links discounted."""
    if any(n.doubtful for n in nodes):
        for (block, here), linked in zip(blocks, links_in, strict=True):
            up: Node | None = here
            while up:
                up.held += len(block)
                up.held_linked += linked
                up.longest = max(up.longest, len(block))
                up = up.parent
    for n in nodes:
        n.settle()
    for (block, here), linked in zip(blocks, links_in, strict=True):
        if here.dropped:
            continue
        gain = max(0.0, len(block) - 2.0 * linked)
        # a paragraph speaks for what holds it, other text for its own element
        up = here.parent if here.tag in (*HEADINGS, "p", "li", "pre", "td", "blockquote") and here.parent else here
        up.direct += gain
        head = here.tag in HEADINGS and bool(gain)
        while up:
            up.score += gain
            up.chars += len(block)
            up.linked += linked
            up.heads += head
            up = up.parent


def climb(node: Node) -> list[Node]:
    """Containers from an element up to the one that holds the page's main text."""
    line, chain = [node], []
    up = node
    while up:
        chain.append(up)
        up = up.parent
    whole = [n for n in chain if n.tag in ("article", "main")]
    if whole:
        return [n for n in chain[:chain.index(whole[-1]) + 1] if n.score]
    for up in chain[1:]:
        here = line[-1]
        added = up.chars - here.chars
        if added > 0 and up.linked - here.linked <= MOST_LINKED * added and (up.heads > here.heads or added >= LEAST_ADDED * here.chars):
            line.append(up)
    return line


def votes(html: str) -> list[tuple[str, float]]:
    """Paths of the page's own container and the last ones on the climb to it, with their share of its score."""
    _, nodes = blocks_of(html)
    line = [n for n in climb(max(nodes, key=lambda n: n.direct)) if n.score]
    return list({n.path: n.score / line[-1].score for n in line[-VOTES:]}.items())


def main_text(html: str, host_path: str | None) -> str:
    """Blocks inside the container that the host's path leads to on this page, or inside the page's own where that holds more."""
    blocks, nodes = blocks_of(html)
    by_path: dict[str, float] = {}
    for n in nodes:
        by_path[n.path] = by_path.get(n.path, 0) + n.score
    own = climb(max(nodes, key=lambda n: n.direct))
    path = own[-1].path if own else ""
    if not by_path[path]:
        return ""
    anchors = [n for n in nodes if n.path == host_path and n.score]
    if anchors:
        led = climb(max(anchors, key=lambda n: n.score))[-1].path
        path = led if by_path[led] >= by_path[path] else path
    inside: dict[int, bool] = {}

    def within(n: Node | None) -> bool:
        chain = []
        while n is not None and id(n) not in inside:
            chain.append(n)
            if n.path == path:
                inside[id(n)] = True
                break
            n = n.parent
        found = n is not None and inside[id(n)]
        for c in chain:
            inside[id(c)] = found
        return found

    return "\n".join(b for b, n in blocks if not n.dropped and within(n))


def _html(pages: DataFrame) -> DataFrame:
    reach_workers(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(host, F.lit("")).alias("host"), F.col("html").cast("string").alias("text"))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of the host's pages, the smallest on a tie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            hosts, paths, shares = [], [], []
            for host, html in zip(part.column("host").to_pylist(), pc.fill_null(part.column("text"), "").to_pylist(), strict=True):
                for path, share in votes(html):
                    hosts.append(host)
                    paths.append(path)
                    shares.append(round(share * 1000))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())], ["host", "path", "share"])
    cast = _html(pages).select("host", "text").mapInArrow(run, "host string, path string, share long")
    totals = cast.groupBy("host", "path").agg(F.sum("share").alias("votes"))
    best = totals.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("less"), "path")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null and empty html, and pages without any running text outside menus, notices
    and the like, give an empty text. Pages whose url is null or names no host vote
    together. Repeated rows give a row each. Only the winning path of each host
    joins the pages; that table is written first, so AQE splits a large host.
    """
    paths = stored(host_paths(pages), "host-paths").select(F.col("host").alias("_host"), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = [
                main_text(html, path)
                for html, path in zip(pc.fill_null(part.column("text"), "").to_pylist(), part.column("path").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    joined = _html(pages).join(paths, F.col("host") == F.col("_host"), "left").select("page_id", "url", "text", "path")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
