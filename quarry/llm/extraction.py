"""Main text of web pages by consensus paths per host.

1. On each page every container is scored by the text of the blocks right
   below it (half for those one level further down), less link text, and the
   page votes for the generalised tag-class path of its best container.
2. Spark adds up the votes per host and path; a path wins with a fifth of its
   host's votes.
3. Every page is read again: of its host's winning paths that it has, the one
   with the most text gives the result; a page with none of them falls back to
   its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments are left out by element, role or name wherever they lie. A
name is a whole class or id of a container; it never drops an element around
the page's longest article or best container. Character references are decoded, white space inside a block becomes one
space and blocks are joined by line feeds in page order.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import stage

DEPTH = 12  # a path names so many elements at most, the innermost ones
SHARE = 5  # a path wins with one in so many of its host's votes, so a host has at most so many
BROADCAST_BYTES = 16_000_000

# Fixed values of HTML and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noframes noscript template xmp svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
FURNITURE = frozenset(
    "nav aside footer form head script style noscript template iframe button select textarea input option label svg math "
    "dialog menu object embed canvas audio video map title".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer footnav gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination popup promo promoted related replies respond search share sharing "
    "shoutbox sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split())
COMPOUNDS = frozenset(
    "ad-banner ad-block ad-box ad-container ad-slot ad-unit ad-wrapper google-ad bottom-bar breadcrumb-nav comment-form comment-list "
    "comments-area comments-list comments-section cookie-banner cookie-bar cookie-consent cookie-notice cookie-popup cookie-policy "
    "footer-links footer-menu footer-nav gdpr-banner header-nav left-sidebar login-form main-menu main-nav main-navigation "
    "mobile-menu mobile-nav nav-bar nav-links nav-menu newsletter-signup page-footer page-header page-navigation post-navigation "
    "primary-menu primary-nav primary-sidebar reader-comments related-articles related-links related-posts related-stories "
    "right-sidebar search-bar search-box search-form secondary-sidebar share-bar share-buttons sharing-buttons side-bar "
    "sidebar-left sidebar-right sidebar-primary sidebar-secondary site-footer site-header site-nav site-navigation skip-link "
    "social-buttons social-icons social-links social-share top-bar top-menu top-nav user-comments widget-area".split())
NAMED = frozenset("center dd details div dl dt fieldset li ol section table td ul".split())  # containers dropped by name
REPLIES = frozenset(
    "comment comments commentlist comment-list comments-area comments-list comments-section disqus reader-comments replies respond "
    "user-comments".split())  # these have texts and articles of their own
MAIN = frozenset("article main".split())
CLOSES = {  # a start tag that ends an open element of these, up to the barrier
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P, _NOT_P = frozenset({"p"}), BLOCK - {"p"}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Page:
    """Elements (parent, path, tag, dropped) and text blocks of a page."""

    def __init__(self, source: str):
        self.elements: list[tuple[int, str, str, bool]] = [(-1, "", "", False)]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, link characters
        self._stack, self._buffer, self._links = [0], [], 0
        self._count: dict[str, int] = {}  # open elements by tag
        self._named: dict[int, bool] = {}  # elements to drop by name, and whether they hold replies
        self._read(source)
        if self._named:
            self._drop_named()

    def _flush(self) -> None:
        if self._buffer:
            text = " ".join(html.unescape("".join(self._buffer)).split())
            if text:
                self.blocks.append((self._stack[-1], text, min(self._links, len(text))))
            self._buffer, self._links = [], 0

    def _text(self, text: str) -> None:
        if text and not self.elements[self._stack[-1]][3]:
            self._buffer.append(text)
            if self._count.get("a"):
                self._links += len(text.strip())

    def _pop_to(self, at: int) -> None:
        if any(self.elements[e][2] in BLOCK for e in self._stack[at:]):
            self._flush()
        for e in self._stack[at:]:
            self._count[self.elements[e][2]] -= 1
        del self._stack[at:]

    def _close_open(self, names, barrier) -> None:
        for at in range(len(self._stack) - 1, 0, -1):
            tag = self.elements[self._stack[at]][2]
            if tag in barrier:
                return
            if tag in names:
                self._pop_to(at)

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._close_open(_P, _NOT_P)
            self._flush()
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        if tag in VOID:
            self._text(" ")
            return
        parent = self._stack[-1]
        above, path, _, dropped = self.elements[parent]
        own = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        inside = any(self._count.get(t) for t in MAIN)
        if not dropped:
            dropped = tag in FURNITURE or tag == "header" and not inside or "hidden" in own or own.get("role", "").lower() in ROLES
            if tag in NAMED and not dropped and ("class" in own or "id" in own):
                names = f"{own.get('class', '')} {own.get('id', '')}".lower().replace("_", "-").split()
                names = {x for x in names if x in NAMES or x in COMPOUNDS}
                if inside:
                    names -= {"header", "page-header"}
                if names:
                    self._named[len(self.elements)] = not REPLIES.isdisjoint(names)
        name = ".".join([tag, *sorted(re.sub(r"\d+", "#", own.get("class", "")).split())])
        if tag in BLOCK:
            path = "/".join(["", *path.split("/")[1:][1 - DEPTH:], name])
        self.elements.append((parent, path, tag, dropped))
        self._stack.append(len(self.elements) - 1)
        self._count[tag] = self._count.get(tag, 0) + 1

    def _read(self, source: str) -> None:
        at = 0
        while m := _TOKEN.search(source, at):
            self._text(source[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if self._count.get(tag):
                    self._pop_to(next(i for i in range(len(self._stack) - 1, 0, -1) if self.elements[self._stack[i]][2] == tag))
                elif tag in BLOCK:
                    self._flush()
                continue
            closed = m[3].rstrip().endswith("/") and tag in ("svg", "math")
            if tag in RAW and not closed:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            self._open(tag, m[3])
        self._text(source[at:])
        self._flush()

    def _above(self, element: int) -> Iterator[int]:
        while element > 0:
            yield element
            element = self.elements[element][0]

    def _drop_named(self) -> None:
        """Drop the blocks below named elements, but for those that hold the
        longest article or main or, further down, the best container. What
        lies in readers' replies is neither unless there is nothing else."""
        replies = self._below({e for e, holds in self._named.items() if holds})
        texts = [b for b in self.blocks if not replies[b[0]]] or self.blocks
        size = [0] * len(self.elements)
        for element, text, _ in texts:
            size[element] += len(text)
        for e in range(len(size) - 1, 0, -1):
            size[self.elements[e][0]] += size[e]
        articles = [e for e in range(1, len(size)) if size[e] and self.elements[e][2] in MAIN]
        kept: set[int] = set()
        if articles:
            kept.update(self._above(max(articles, key=lambda e: (size[e], -e))))
        worth = self._worth(texts)
        if worth and max(worth.values()) > 0:
            best = max(worth, key=lambda e: (worth[e], -e))
            kept.update(self._above(self.elements[best][0]))
        gone = self._below(self._named.keys() - kept)
        self.blocks = [b for b in self.blocks if not gone[b[0]]]

    def _below(self, roots: set[int]) -> list[bool]:
        """Whether each element is or is below one of the roots."""
        out = [False] * len(self.elements)
        for e in range(1, len(out)):
            out[e] = e in roots or out[self.elements[e][0]]
        return out

    def _holder(self, element: int) -> int:
        """The nearest block element that is or is above an element."""
        while element > 0 and self.elements[element][2] not in BLOCK:
            element = self.elements[element][0]
        return element

    def _worth(self, blocks: list[tuple[int, str, int]]) -> dict[int, float]:
        """Text by container: a paragraph counts for the container above it."""
        out: dict[int, float] = {}
        for element, text, links in blocks:
            worth = len(text) - 2 * links
            at = self._holder(element)
            if self.elements[at][2] not in ("div", "section", "body", "html", "") and self.elements[at][2] not in MAIN:
                at = self._holder(self.elements[at][0])
            for share in (1.0, 0.5):
                if at <= 0:
                    break
                out[at] = out.get(at, 0.0) + worth * share * (1.5 if self.elements[at][2] in MAIN else 1.0)
                at = self._holder(self.elements[at][0])
        return out

    def scores(self) -> dict[str, float]:
        """Text by path of its container."""
        out: dict[str, float] = {}
        for at, worth in self._worth(self.blocks).items():
            path = self.elements[at][1]
            out[path] = out.get(path, 0.0) + worth
        return out

    def best(self) -> str | None:
        """Path of the container with the highest score above 0."""
        found = {p: s for p, s in self.scores().items() if s > 0}
        return min(found, key=lambda p: (-found[p], p)) if found else None

    def text(self, path: str | None) -> str:
        """The blocks below the elements of a path, or all without one."""
        inside = [path is None] * len(self.elements)
        for i in range(1, len(self.elements)):
            parent, own, tag, _ = self.elements[i]
            inside[i] = inside[parent] or own == path and tag in BLOCK
        return "\n".join(text for element, text, _ in self.blocks if inside[element])


def main_text(source: str | None, winners: list[str] | None = None) -> str:
    """Main text of a page given its host's winning paths; null is empty."""
    page = Page(source or "")
    found = [t for t in map(page.text, winners or ()) if t]
    return max(found, key=len) if found else page.text(page.best())


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple, int] = {}
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            for host, source in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                if best := Page(source or "").best():
                    votes[host, best] = votes.get((host, best), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), pa.array(list(votes.values()), pa.int64())],
            ["_host", "path", "votes"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            texts = [main_text(s, w) for s, w in zip(rows.column("_html").to_pylist(), rows.column("_paths").to_pylist())]
            yield pa.RecordBatch.from_arrays([rows.column("_row"), pa.array(texts, pa.string())], ["_row", "text"])


def host_paths(pages: DataFrame, source: str = "html", url: str = "url") -> DataFrame:
    """(_host, _paths): the winning paths of every host."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _HOST, 1))
    votes = pages.select(host.alias("_host"), F.col(source).alias("_html")).mapInArrow(_votes, "_host string, path string, votes long")
    votes = stage(votes.groupBy("_host", "path").agg(F.sum("votes").alias("votes")), "votes")
    total = votes.groupBy("_host").agg(F.sum("votes").alias("total"))
    winning = votes.join(total, "_host").where(SHARE * F.col("votes") >= F.col("total"))
    return winning.groupBy("_host").agg(F.array_sort(F.collect_list("path")).alias("_paths"))


def extract(pages: DataFrame, source: str = "html", url: str = "url", carry: list[str] | None = None) -> DataFrame:
    """``_row`` (a struct of the carried columns) and text for every page.

    A null or empty page, or one without main text, gives the empty string;
    pages without a host form one host. Repeated rows get equal answers. The
    hosts' paths are broadcast when their written size is at most
    BROADCAST_BYTES; else pages are joined by host, where the skew join splits
    a hot host.
    """
    paths = stage(host_paths(pages, source, url), "paths")
    size = paths.agg(F.sum(F.octet_length("_host") + F.octet_length(F.array_join("_paths", " ")) + 64)).first()[0] or 0
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or pages.columns)])
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _HOST, 1))
    frame = pages.select(row.alias("_row"), F.col(source).alias("_html"), host.alias("_host"))
    frame = frame.join(F.broadcast(paths) if size <= BROADCAST_BYTES else paths, "_host", "left").select("_row", "_html", "_paths")
    return frame.mapInArrow(_extracted, f"_row {frame.schema['_row'].dataType.simpleString()}, text string")
